import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from levyscan.functions.scalars import hash_number
from levyscan.operators import ordering


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows share one sort value."""
    return spark.range(5000).selectExpr("id", "if(id % 3 = 0, 7, (id * 7919) % 1000) as v").repartition(7)


def test_numbers_equal_a_global_row_number(spark, rows):
    got = ordering.number_rows(rows, ["v", "id"], "n")
    want = rows.withColumn("n", F.row_number().over(Window.orderBy("v", "id")).cast("bigint"))
    assert got.select("id", "n").exceptAll(want.select("id", "n")).isEmpty()
    assert got.count() == 5000


def test_numbers_stay_the_same_when_read_again(spark, rows):
    got = ordering.number_rows(rows, ["v", "id"], "n")
    assert got.exceptAll(got.select(*got.columns)).isEmpty()
    assert sorted(r.n for r in got.select("n").collect()) == list(range(1, 5001))


def test_no_row_data_in_a_single_partition(spark, rows):
    plan = ordering.number_rows(rows, ["v", "id"], "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1  # the offsets, one row per partition
    assert "BroadcastHashJoin" in plan


def test_running_totals(spark, rows):
    got = ordering.running_totals(rows, ["v", "id"], {"total": "id"})
    over = Window.orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("total", F.sum("id").over(over))
    assert got.select("id", "total").exceptAll(want.select("id", "total")).isEmpty()


def test_sample_rows_is_exact_at_any_size(spark, rows):
    hashed = rows.withColumn("h", hash_number("s", F.col("id")))
    for n in (40, 999, 1001, 4000):
        want = {r.id for r in hashed.orderBy("h", "id").limit(n).collect()}
        assert {r.id for r in ordering.sample_rows(rows, n, "s", "id").collect()} == want
    assert ordering.sample_rows(rows, 9000, "s", "id").count() == 5000


def test_top_k_breaks_ties_by_key(spark):
    flags = spark.createDataFrame([(f"PO{i}", s) for i, s in enumerate([60.0, 60.0, 50.0, 70.0, 60.0])], "po_id string, rule_score double")
    assert [r.po_id for r in ordering.top_suspicious(flags, 3).collect()] == ["PO0", "PO1", "PO4"]


def test_clusters(spark):
    ids = spark.range(10)
    got = ordering.fixed_size_clusters(ids, ["id"], 4, "c").orderBy("id").collect()
    assert [r.c for r in got] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]


def test_a_sample_puts_only_rows_near_it_in_order(spark, rows, monkeypatch):
    ordered = []
    written = ordering._written_in_order
    monkeypatch.setattr(ordering, "_written_in_order", lambda df, order: ordered.append(df.count()) or written(df, order))
    for n in (0, 1, 100, 5000, 6000):
        got = ordering.sample_rows(rows, n, "few", "id")
        want = rows.withColumn("h", hash_number("few", F.col("id"))).orderBy("h", "id").limit(n).drop("h")
        assert got.columns == rows.columns and got.count() == min(n, 5000)
        assert got.exceptAll(want).isEmpty()
    assert ordered[2] < 400 and ordered[3:] == [5000, 5000]


def test_a_sample_whose_hashes_lie_high_is_whole(spark, rows):
    """Fewer rows than asked for lie in the share of the hash range looked at first."""
    high = rows.filter(hash_number("few", F.col("id")) > F.lit(1 << 59))
    got = ordering.sample_rows(high, 100, "few", "id")
    want = high.withColumn("h", hash_number("few", F.col("id"))).orderBy("h", "id").limit(100).drop("h")
    assert got.count() == 100 and got.exceptAll(want).isEmpty()
