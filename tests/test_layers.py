from functools import reduce
from operator import add

from pyspark.sql import functions as F

from levyscan.checks.views import AS_OF
from levyscan.constants import FEATURES, FLAG_TABLE_COLUMNS, RULE_FLAGS
from levyscan.plans import gold
from levyscan.plans.bronze import Layer
from levyscan.plans.silver import build_silver
from levyscan.sources import files


def test_silver_keeps_every_order_once(inputs, silver):
    orders = inputs.orders.count()
    assert silver.count() == orders
    assert silver.select("po_id").distinct().count() == orders
    assert len(silver.columns) == len(set(silver.columns))


def test_score_follows_from_the_flags(silver):
    total = reduce(add, [F.col(f) for f in RULE_FLAGS])
    assert silver.filter((total != F.col("rule_fail_count")) | (F.col("rule_score") != 100 - 10 * total)).isEmpty()
    for flag in RULE_FLAGS:
        assert silver.filter(~F.col(flag).isin(0, 1) | F.col(flag).isNull()).isEmpty()


def test_every_rule_meets_both_outcomes(silver):
    got = silver.agg(*[F.countDistinct(f).alias(f) for f in RULE_FLAGS]).first().asDict()
    del got["director_overlap_flag"]  # ten vendors share no director at this size
    assert set(got.values()) == {2}


def test_large_table_path_gives_the_same_silver(inputs, silver):
    """No lookup is broadcast and nearly every vendor counts as a hot key."""
    spread = build_silver(inputs.bronze, AS_OF, broadcast_rows=0, rows_per_salt=10)
    assert spread.count() == silver.count()
    same = spread.select(*silver.columns)
    assert same.exceptAll(silver).isEmpty()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_plan(inputs):
    plan = plan_of(inputs.silver)
    assert "EvalPython" not in plan  # names are scored on the table of distinct pairs
    assert "Window" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_wide_rows_move_once_after_the_layout(spark, inputs):
    """Without any broadcast the wide orders meet invoices, labels and facts in their buckets,
    and are exchanged for the vendor's profile alone."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wide = build_silver(inputs.bronze, AS_OF, broadcast_rows=0)
        assert "BroadcastHashJoin" not in plan_of(wide)
        exchanges = _wide_exchanges(wide._jdf.queryExecution().executedPlan())
        assert exchanges == [["vendor_id", "year_month"]]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_wide_rows_of_many_orders_stay_in_their_buckets(spark, inputs, silver):
    """The profile comes home with the facts of the sheet: no exchange holds order columns."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wide = build_silver(inputs.bronze, AS_OF, many_orders=0, broadcast_rows=0)
        assert "BroadcastHashJoin" not in plan_of(wide)
        assert ["vendor_id", "year_month"] not in _wide_exchanges(wide._jdf.queryExecution().executedPlan())
        assert wide.columns == silver.columns and wide.dtypes == silver.dtypes
        assert wide.exceptAll(silver).isEmpty() and silver.exceptAll(wide).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _wide_exchanges(node) -> list[list[str]]:
    """Keys of the exchanges whose rows have 30 columns or more."""
    if node.nodeName().startswith("AdaptiveSparkPlan"):
        return _wide_exchanges(node.executedPlan())
    found = []
    if node.nodeName() == "Exchange" and node.output().size() >= 30:
        text = node.simpleString(1000)
        keys = text[text.index("hashpartitioning(") + 17 :].split(", ")
        found.append(sorted({k.split("#")[0].removeprefix("coalesce(") for k in keys if "#" in k and not k.startswith("isnull")}))
    children = node.children()
    for i in range(children.size()):
        found += _wide_exchanges(children.apply(i))
    return found


def test_repeated_order_ids_keep_their_own_facts(spark, inputs):
    """Two rows of one order id with different vendors each get their own vendor's counts."""
    layer = inputs.bronze
    other = layer.purchase_orders.filter("po_id = 'PO0000003'").withColumn("vendor_id", F.lit("V00001"))
    both = Layer(**{**vars(layer), "purchase_orders": layer.purchase_orders.unionByName(other)})
    rows = build_silver(both, AS_OF).filter("po_id = 'PO0000003'").collect()
    master = {r.vendor_id: r.gstin for r in layer.vendors.collect()}
    assert len(rows) == 2 and {r.vendor_id for r in rows} >= {"V00001"}
    assert all(r.gstin == master.get(r.vendor_id) for r in rows)


def test_gold_tables(inputs, silver):
    flags = inputs.flags
    assert flags.count() == silver.count()
    assert set(FLAG_TABLE_COLUMNS) <= set(flags.columns)
    risk = gold.gold_vendor_risk(silver)
    sums = risk.agg(F.sum("total_po_count"), F.sum("anomaly_count")).first()
    want = silver.agg(F.count("*"), F.sum("is_anomalous")).first()
    assert tuple(sums) == tuple(want)


def test_features_are_in_silver(silver):
    assert set(FEATURES) <= set(silver.columns)


def test_hot_partition_value_is_written_by_many_tasks(spark, inputs):
    import glob

    rows = spark.range(400_000).selectExpr("md5(cast(id as string)) as t", "if(id % 3 = 0, 7, id % 50) as m")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        files.write_partitioned(rows, str(tmp_path / "hot"), "m")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(str(tmp_path / "hot" / "m=7" / "*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 400_000


def test_month_filter_prunes_partitions(spark, inputs, tmp_path):
    slim = inputs.orders.select("po_id", "total_amount", "year", "month")
    path = files.write_partitioned(slim, str(tmp_path / "orders"), "year", "month")
    back = spark.read.parquet(path)
    assert back.count() == slim.count()
    plan = back.filter("year = 1997 and month = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_gold_reads_only_the_columns_it_needs(silver):
    plan = gold.gold_vendor_risk(silver)._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema") :]
    assert "total_amount" in read and "invoice_billing_name" not in read and "ewb_number" not in read


def test_csv_header_is_checked(spark, tmp_path):
    import pytest

    from levyscan.schemas import RATE_FIELDS, raw_schema

    path = files.export_csv(spark.createDataFrame([("a", "b")], "x string, y string"), str(tmp_path / "bad"))
    with pytest.raises(Exception, match="CSV header"):
        files.read_csv(spark, path, raw_schema(RATE_FIELDS)).collect()


def test_unreadable_lines_are_written_by_many_tasks(spark, inputs):
    """The lines that go into quarantine are made where the rows are, not in one task."""
    from levyscan.checks import catalog_tables
    from levyscan.checks.registry import Inputs
    from levyscan.schemas import INPUT_FIELDS

    t = Inputs(spark, inputs.base)
    orders = t.raw.purchase_orders.repartition(4).localCheckpoint()
    t.raw.__dict__["purchase_orders"] = orders
    path = catalog_tables._raw_files(t, "purchase_orders")
    broken = spark.read.text(path).filter("value like 'word,%'").groupBy(F.input_file_name()).count()
    assert broken.count() > 1
    n = orders.count()
    good, bad = files.read_checked(spark, path, INPUT_FIELDS["purchase_orders"], "purchase_orders")
    assert good.count() == n
    assert {r["reason"]: r["count"] for r in bad.groupBy("reason").count().collect()} == {"number of values": n, "type of quantity": n}


def test_risk_and_flags_do_not_write_the_wide_table(spark, inputs):
    """Of the silver layer they make only the columns they need."""
    from levyscan.checks.registry import Inputs

    t = Inputs(spark, inputs.base)
    assert t.risk.count() > 0 and set(FLAG_TABLE_COLUMNS) <= set(t.flags.columns)
    assert "silver_table" not in vars(t)


def test_the_feature_matrix_writes_no_order_columns_that_are_only_passed_on(spark, inputs, silver, monkeypatch):
    from levyscan.checks.registry import Inputs
    from levyscan.operators.models import feature_matrix
    from levyscan.plans import silver as plan

    laid = {}
    laid_out = plan.laid_out
    monkeypatch.setattr(plan, "laid_out", lambda df, key, name: laid.update({name: df.columns}) or laid_out(df, key, name))
    t = Inputs(spark, inputs.base)
    got, want = getattr(t, "features", t.silver), feature_matrix(silver)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert "total_amount" in laid["orders"] and not {"product_desc", "unit", "delivery_state"} & set(laid["orders"])


def test_columns_of_silver_are_those_of_the_wide_table(inputs, silver):
    wanted = ["po_id", "product_desc", "severity", "rule_score", "ewb_generated_date"]
    for many in (0, 1_000_000):
        some = build_silver(inputs.bronze, AS_OF, many_orders=many, columns=wanted)
        assert some.columns == wanted
        assert some.exceptAll(silver.select(*wanted)).isEmpty() and some.count() == silver.count()
