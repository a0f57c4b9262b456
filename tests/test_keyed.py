import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from levyscan.operators import keyed


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows: a third share one key, a tenth have none."""
    return spark.range(3000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else concat('k', id % 400) end as k"
    )


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_spread_join_equals_plain_join(spark, skewed):
    right = skewed.filter("k is not null").groupBy("k").agg(F.max("id").alias("top"))
    counts = keyed.key_counts(skewed, ["k"])
    got = keyed.spread_left_join(skewed, right, ["k"], counts, ["id"], rows_per_salt=50)
    assert "_salt" in plan_of(got)
    want = skewed.join(right, "k", "left")
    assert got.count() == 3000
    assert got.select("id", "k", "top").exceptAll(want.select("id", "k", "top")).isEmpty()


def test_spread_join_cuts_the_hot_key_into_even_slices(spark, skewed):
    counts = keyed.key_counts(skewed, ["k"])
    salts = {r.k: r._salts for r in keyed.heavy_keys(counts, ["k"], rows_per_salt=50).collect()}
    assert salts["hot"] == 20
    assert None in salts
    slices = (
        skewed.filter("k = 'hot'").groupBy(F.pmod(F.xxhash64("id"), F.lit(20)).alias("s")).count().collect()
    )
    assert len(slices) == 20
    assert max(r["count"] for r in slices) < 100


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0, "rows_per_salt": 50}, {"broadcast_rows": 0}])
def test_count_within_equals_a_window(spark, skewed, options):
    got = keyed.count_within(skewed, ["k"], "n", ["id"], **options)
    want = skewed.withColumn("n", F.count("*").over(Window.partitionBy("k")))
    assert got.select("id", "n").exceptAll(want.select("id", "n")).isEmpty()
    assert got.count() == 3000
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_is_broadcast_only_when_small(spark, skewed):
    right = skewed.filter("k is not null").select("k").distinct().withColumn("v", F.lit(1))
    small = keyed.lookup_join(skewed, right, ["k"], ["id"])
    large = keyed.lookup_join(skewed, right, ["k"], ["id"], broadcast_rows=5)
    assert "rightHint=(strategy=broadcast)" in plan_of(small)
    assert "strategy=broadcast" not in plan_of(large)
    assert small.exceptAll(large.select(*small.columns)).isEmpty()


def test_one_per_key_takes_the_least_row_on_any_layout(spark):
    rows = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "z", 1), (1, None, 5)], "k int, a string, n int")
    for parts in (1, 3):
        got = keyed.one_per_key(rows.repartition(parts), ["k"]).orderBy("k").collect()
        assert [tuple(r) for r in got] == [(1, "a", 9), (2, "z", 1)]  # a missing value comes last
    first = keyed.one_per_key(rows, ["k"], prefer=["n"]).orderBy("k").first()
    assert tuple(first) == (1, "b", 2)


def test_director_counts_leave_missing_pans_open(spark):
    vendors = spark.createDataFrame([("a", "P1"), ("b", "P1"), ("c", "P2"), ("d", None)], "vendor_id string, director_pan_1 string")
    for options in ({}, {"broadcast_rows": 0, "rows_per_salt": 1}):
        got = keyed.attach_director_counts(vendors, vendors, **options)
        assert {r.vendor_id: r.director_vendor_count for r in got.collect()} == {"a": 2, "b": 2, "c": 1, "d": None}
