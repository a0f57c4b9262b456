import pytest
from pyspark.sql import functions as F

from levyscan.checks.catalog_tables import _raw_headers
from levyscan.checks.views import AS_OF
from levyscan.plans import jobs
from levyscan.schemas import INPUT_FIELDS, RATE_FIELDS
from levyscan.sources import files, published


@pytest.fixture(scope="module")
def raw(inputs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    for name, fields in INPUT_FIELDS.items():
        table = getattr(inputs.raw, name).select(*[c for _, c, _ in fields])
        files.export_csv(_raw_headers(table, fields), f"{folder}/{name}")
    return folder


@pytest.fixture(scope="module")
def base(spark, raw, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("layers"))
    jobs.bronze_job(spark, raw, folder, AS_OF)
    jobs.silver_job(spark, folder, AS_OF)
    jobs.score_job(spark, folder, trees=4, depth=4, rounds=2)
    jobs.gold_job(spark, folder, AS_OF)
    return folder


def test_layers_are_whole(spark, base, inputs, silver):
    orders = published.read_layer(spark, base, "bronze", "purchase_orders")
    assert orders.count() == inputs.orders.count()
    assert published.read_layer(spark, base, "bronze", "quarantine").count() == 0
    wide = published.read_layer(spark, base, "silver", "orders")
    assert wide.count() == silver.count()
    assert wide.select("po_id", "rule_score", "name_sim_score").exceptAll(silver.select("po_id", "rule_score", "name_sim_score")).isEmpty()
    flags = published.read_layer(spark, base, "gold", "anomaly_flags")
    assert flags.count() == silver.count()
    gaps = flags.agg(*[F.count_if(F.col(c).isNull()) for c in ("rf_probability", "xgb_probability", "rf_prediction", "xgb_prediction")]).first()
    assert tuple(gaps) == (0, 0, 0, 0)
    assert flags.filter("not rf_probability between 0 and 1 or not xgb_probability between 0 and 1").isEmpty()
    tiers = published.read_layer(spark, base, "scores", "xgb_predictions")
    assert "risk_tier" in tiers.columns and tiers.count() == silver.count()


def test_metrics_tell_what_was_written(spark, base):
    for layer in ("bronze", "silver", "scores", "gold"):
        for row in published.read_layer(spark, base, layer, "metrics").collect():
            assert row.rows == published.read_layer(spark, base, layer, row.table).count()


def test_a_failed_job_leaves_the_old_layer(spark, base, inputs):
    before = published.current(spark, base, "silver")
    broken = inputs.orders.withColumn("total_amount", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        published.write_layer(spark, base, "silver", {"orders": broken})
    assert published.current(spark, base, "silver") == before
    assert published.read_layer(spark, base, "silver", "orders").count() == inputs.orders.count()


def test_old_versions_are_retired(spark, tmp_path):
    rows = spark.range(3)
    folders = [published.write_layer(spark, str(tmp_path), "x", {"t": rows.filter(F.col("id") <= i)}) for i in range(3)]
    assert published.current(spark, str(tmp_path), "x") == folders[-1]
    assert len(published.retire(spark, str(tmp_path), "x", keep=1)) == 2
    assert published.read_layer(spark, str(tmp_path), "x", "t").count() == 3
    with pytest.raises(FileNotFoundError):
        published.current(spark, str(tmp_path), "y")


def test_each_raw_line_is_read_or_in_quarantine(spark, tmp_path):
    header = ",".join(h for h, _, _ in RATE_FIELDS)
    lines = [header, "A,goods,5.0,No,2017", "B,goods", "C,goods,five,No,2017", 'D,"two, parts",,No,2017', "E,goods,1,No,2017,more"]
    spark.createDataFrame([(x,) for x in lines], "l string").coalesce(1).write.text(str(tmp_path / "rates"))
    good, bad = files.read_checked(spark, str(tmp_path / "rates"), RATE_FIELDS, "rates")
    assert sorted((r.hsn_code, r.description, r.gst_rate) for r in good.collect()) == [("A", "goods", 5.0), ("D", "two, parts", None)]
    assert sorted((r.input, r.reason, r.line) for r in bad.collect()) == [
        ("rates", "number of values", "B,goods"),
        ("rates", "number of values", "E,goods,1,No,2017,more"),
        ("rates", "type of gst_rate", "C,goods,five,No,2017"),
    ]
    assert bad.count() == 3 and good.count() == 2
