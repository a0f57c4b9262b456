"""Rollups, profiles and reconciliation counts. All use partial aggregation."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyscan.functions.scalars import exact_avg, exact_sum, year_month
from levyscan.operators.rules import vendor_risk_tier


def history_from_orders(df: DataFrame, value: str = "total_amount") -> DataFrame:
    """Mean value and number of orders per vendor and month."""
    return df.groupBy("vendor_id", year_month(F.col("po_date")).alias("year_month")).agg(
        exact_avg(F.col(value), 6).alias("total_po_value"), F.count("*").alias("po_count")
    )


def merge_history(history: DataFrame, history_value_is: str = "average") -> DataFrame:
    """One row per vendor and month.

    "average" averages value and count as delivered. "total" first turns the delivered mean
    back into a total (mean x count), so that value/count is the mean value per order.
    """
    if history_value_is == "total":
        total = exact_sum(F.col("total_po_value") * F.col("po_count"))
        return history.groupBy("vendor_id", "year_month").agg(
            total.alias("total_po_value"), F.sum("po_count").cast("double").alias("po_count")
        )
    return history.groupBy("vendor_id", "year_month").agg(
        exact_avg(F.col("total_po_value"), 6).alias("total_po_value"),
        F.avg("po_count").alias("po_count"),
    )


def vendors_per_director(df: DataFrame) -> DataFrame:
    """Distinct vendors per director PAN. The pairs are made distinct first, so a popular
    PAN reaches the count as one row per vendor, already halved map-side."""
    return (
        df.select("director_pan_1", "vendor_id")
        .distinct()
        .groupBy("director_pan_1")
        .agg(F.count("vendor_id").alias("director_vendor_count"))
    )


def vendor_risk(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy("vendor_id", "trade_name", "gstin")
        .agg(
            exact_sum(F.col("total_amount")).alias("total_po_value"),
            F.count("*").alias("total_po_count"),
            F.sum("is_anomalous").alias("anomaly_count"),
            (F.sum("is_anomalous") / F.count("*")).alias("anomaly_rate"),
            exact_avg(F.col("name_sim_score")).alias("avg_name_sim_score"),
            exact_avg(F.col("filing_compliance_rate")).alias("filing_compliance_rate"),
        )
    )


def with_risk_tier(risk: DataFrame) -> DataFrame:
    return risk.withColumn("risk_tier", vendor_risk_tier())


def rate_summary(risk: DataFrame) -> DataFrame:
    return risk.agg(
        F.max("anomaly_rate").alias("max_rate"),
        F.min("anomaly_rate").alias("min_rate"),
        exact_avg(F.col("anomaly_rate")).alias("avg_rate"),
    )


def frequencies(df: DataFrame, *columns: str) -> DataFrame:
    """Value counts of many columns in one pass: each row is unpivoted to (column, value)
    and the counts collapse map-side."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count("*").alias("n"))
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def key_check(df: DataFrame, *keys: str, approximate: bool = False) -> DataFrame:
    """Rows against distinct keys. The exact form counts per key first, so that no task
    holds a set of keys."""
    if approximate:
        whole = F.struct(*keys)
        return df.agg(F.count("*").alias("n_rows"), F.approx_count_distinct(whole).alias("n_keys"))
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, one scan, long format."""
    counts = df.select(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in df.columns]
    )
    return counts.select(F.inline(pairs))


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def executive_kpis(silver: DataFrame, risk: DataFrame, high_tiers=("Critical", "High")) -> DataFrame:
    """Totals plus the number of high-risk vendors. Both sides reach the final aggregate as
    partial rows of one shape, so no join is needed."""
    orders = silver.agg(
        F.count("*").alias("total_pos"),
        exact_sum(F.col("total_amount")).alias("total_po_value"),
        F.coalesce(F.sum("is_anomalous"), F.lit(0)).alias("total_anomalies"),
    ).withColumn("high_risk_vendors", F.lit(None).cast("bigint"))
    vendors = risk.agg(
        F.count(F.when(F.col("risk_tier").isin(*high_tiers), 1)).alias("high_risk_vendors")
    )
    both = orders.unionByName(vendors, allowMissingColumns=True)
    merged = both.agg(*[F.max(c).alias(c) for c in orders.columns])
    return merged.withColumn(
        "anomaly_rate", F.try_divide(F.col("total_anomalies"), F.col("total_pos"))
    )


def compliance_by_tier(risk: DataFrame) -> DataFrame:
    return risk.groupBy("risk_tier").agg(
        F.count("*").alias("n_vendors"),
        exact_avg(F.col("filing_compliance_rate")).alias("avg_compliance"),
    )


def distinct_sketches(df: DataFrame, by: list[str], columns: list[str], lg_k: int = 12) -> DataFrame:
    """One row per group with a sketch of each column's distinct values. A sketch has a few
    kilobytes whatever the number of values, and sketches of several groups, days or tables can
    be merged: the distinct count of a year needs no second pass over its rows."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(c, lg_k).alias(f"{c}_sketch") for c in columns])


def merged_estimates(sketches: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Estimated distinct counts per group, and over all groups in a row with null groups."""
    merged = sketches.groupingSets([by, []], *by).agg(*[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in columns])
    return merged.select(*by, *[F.hll_sketch_estimate(f"{c}_sketch").alias(f"{c}_estimate") for c in columns])
