"""Gold tables: anomaly flags with model scores, vendor risk, and the order drill-down."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyscan.constants import FLAG_TABLE_COLUMNS
from levyscan.operators import rules
from levyscan.operators.aggregates import vendor_risk, with_risk_tier
from levyscan.operators.casework import attach_vendor_risk, parse_responses
from levyscan.operators.projection import with_audit_timestamp


def attach_scores(flags: DataFrame, forest: DataFrame, boosted: DataFrame) -> DataFrame:
    """Both model scores on the order id: one layout serves the two joins."""
    return flags.join(
        forest.select("po_id", "rf_prediction", "rf_probability"), "po_id", "left"
    ).join(boosted.select("po_id", "xgb_prediction", "xgb_probability"), "po_id", "left")


def gold_anomaly_flags(
    silver: DataFrame, forest: DataFrame, boosted: DataFrame, as_of: str | None = None
) -> DataFrame:
    flags = with_audit_timestamp(silver.select(*FLAG_TABLE_COLUMNS), "gold_created_ts", as_of)
    return attach_scores(
        flags.withColumn("severity_dashboard", rules.severity_dashboard()), forest, boosted
    )


def gold_vendor_risk(silver: DataFrame) -> DataFrame:
    return with_risk_tier(vendor_risk(silver))


def order_drilldown(flags: DataFrame, risk: DataFrame, responses: DataFrame, po_id: str) -> DataFrame:
    """Everything known about one order: flags, scores, vendor tier and the analyst's view.
    The key filter reaches all three inputs before they are joined. The vendor list that thins
    out the risk table is as long as the order's rows; Spark picks the join by its size."""
    flagged = flags.filter(F.col("po_id") == po_id)
    its_vendor = flagged.select("vendor_id").distinct()
    one = attach_vendor_risk(flagged, risk.join(its_vendor, "vendor_id", "left_semi"))
    parsed = parse_responses(responses.filter(F.col("po_id") == po_id))
    return one.join(parsed, "po_id", "left")
