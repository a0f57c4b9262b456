"""Pairs each named query with the SQL that must give the same rows."""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyscan.checks.views import AS_OF, with_views
from levyscan.functions.scalars import hash_number, mark_to_flag
from levyscan.constants import BOOSTED_NAME, FEATURES, FILING_QUARTERS, FOREST_NAME
from levyscan.operators.models import decide, feature_matrix, prediction_table
from levyscan.operators.setops import append_by_name
from levyscan.plans import bronze, gold, silver
from levyscan.sources import trade_tables
from levyscan.sources.staging import stage


class RawTables:
    """The seven inputs, each built when first asked for."""

    def __init__(self, spark: SparkSession, base: str):
        self._at = (spark, base)

    @cached_property
    def purchase_orders(self) -> DataFrame:
        return trade_tables.purchase_orders(*self._at)

    @cached_property
    def vendors(self) -> DataFrame:
        return trade_tables.vendors(*self._at)

    @cached_property
    def vendor_invoices(self) -> DataFrame:
        return trade_tables.vendor_invoices(*self._at)

    @cached_property
    def hsn_rate_schedule(self) -> DataFrame:
        return trade_tables.rates(*self._at)

    @cached_property
    def cbic_blacklist(self) -> DataFrame:
        return trade_tables.blacklist(*self._at)

    @cached_property
    def historical_po_values(self) -> DataFrame:
        return trade_tables.spend_history(*self._at)

    @cached_property
    def ground_truth(self) -> DataFrame:
        return trade_tables.ground_truth(*self._at)


class Inputs:
    """The layers over one set of trade tables, built when first asked for."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self.raw = RawTables(spark, self.base)

    def table(self, name: str) -> DataFrame:
        return trade_tables.read(self.spark, self.base, name)

    @cached_property
    def bronze(self) -> bronze.Layer:
        return bronze.build_bronze(self.raw, AS_OF)

    @cached_property
    def bronze_vendors(self) -> DataFrame:
        return bronze.bronze_vendors(self.raw.vendors, AS_OF)

    @cached_property
    def orders(self) -> DataFrame:
        return bronze.bronze_purchase_orders(self.raw.purchase_orders, AS_OF)

    @cached_property
    def vendor_flags(self) -> DataFrame:
        """Marks as numbers, gaps still open."""
        flags = {q: F.when(F.col(q).isNotNull(), mark_to_flag(F.col(q))) for q in FILING_QUARTERS}
        return self.raw.vendors.withColumns({**flags, "composition_flag": mark_to_flag(F.col("composition_flag"))})

    @cached_property
    def orders_with_vendor(self) -> DataFrame:
        return silver.attach_vendor(self.orders, self.bronze_vendors)

    @cached_property
    def orders_with_invoice(self) -> DataFrame:
        return silver.attach_invoice(self.orders, self.raw.vendor_invoices)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.build_silver(self.bronze, AS_OF)

    @cached_property
    def silver_table(self) -> DataFrame:
        """The silver layer as a written table, for queries that read it more than once."""
        return stage(self.silver, "silver")

    @cached_property
    def features(self) -> DataFrame:
        """The feature matrix: of the orders only what the rules read is written on the way."""
        return feature_matrix(silver.build_silver(self.bronze, AS_OF, columns=["po_id", "is_anomalous", *FEATURES]))

    @cached_property
    def risk(self) -> DataFrame:
        """The vendor risk as a written table: of the silver layer only its columns are made."""
        return stage(gold.gold_vendor_risk(self.silver), "risk")

    @cached_property
    def scores(self) -> DataFrame:
        """A stand-in score table: two models with ties, one better than the other."""
        labels = self.raw.ground_truth.select("po_id", F.col("is_anomalous").alias("label"))
        po, label = F.col("po_id"), F.col("label")
        forest = (hash_number("forest", po) % 1000) / F.lit(1000.0)
        boosted = (hash_number("boosted", po) % 1000 + 300 * label) / F.lit(1300.0)

        def table(name, probability, threshold):
            return labels.withColumn("probability", probability).select(
                "po_id",
                "label",
                decide(F.col("probability"), threshold).alias("prediction"),
                "probability",
                F.lit(name).alias("model_name"),
            )

        return append_by_name(table(FOREST_NAME, forest, 0.5), table(BOOSTED_NAME, boosted, 0.35))

    def scores_of(self, name: str) -> DataFrame:
        return self.scores.filter(F.col("model_name") == name)

    @cached_property
    def flags(self) -> DataFrame:
        forest = prediction_table(self.scores_of(FOREST_NAME), "rf")
        boosted = prediction_table(self.scores_of(BOOSTED_NAME), "xgb", with_tier=True)
        return gold.gold_anomaly_flags(self.silver, forest, boosted, AS_OF)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query over `Inputs`, with its SQL when the result can be put in SQL."""

    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, base: build(Inputs(spark, base))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register
