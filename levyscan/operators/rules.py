"""Compliance rules and model features as column expressions on the wide order table.

Unknown input never raises a flag: every flag is 0 unless its condition is known to hold.
"""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyscan.constants import (
    EWB_REQUIRED_ABOVE,
    FILING_QUARTERS,
    FILINGS_REQUIRED,
    HIGH_VALUE_ABOVE,
    LATE_AFTER_DAYS,
    LOWEST_BAND,
    NAME_MATCH_FLOOR,
    RULE_FLAGS,
    SEVERITY_BANDS,
    SPIKE_LIMIT,
    VENDOR_TIER_BANDS,
)
from levyscan.functions.scalars import (
    as_of_date,
    band,
    days_between,
    differs_ignoring_case,
    flag,
    gstin_is_valid,
    round_half_up,
    safe_ratio,
    state_code,
    state_name,
)
from levyscan.operators.keyed import count_within

DUPLICATE_KEYS = ["gstin", "invoice_number", "year", "month"]
SAME_DAY_KEYS = ["vendor_id", "invoice_date"]


# --- buyer registration and rates ---------------------------------------------------
def is_gstin_valid() -> Column:
    return gstin_is_valid(F.col("buyer_gstin"))


def gst_state_code() -> Column:
    return state_code(F.col("buyer_gstin"))


def gst_state_name() -> Column:
    return state_name(gst_state_code())


def state_mismatch() -> Column:
    return flag(differs_ignoring_case(F.col("buyer_state"), gst_state_name()))


def actual_gst_rate() -> Column:
    return F.col("cgst_rate") + F.col("sgst_rate") + F.col("igst_rate")


def rate_mismatch() -> Column:
    return flag(actual_gst_rate() != F.col("gst_rate"))


def hsn_rate_delta() -> Column:
    return F.abs(actual_gst_rate() - F.col("gst_rate"))


# --- value against history ----------------------------------------------------------
def avg_po_value() -> Column:
    return round_half_up(F.try_divide(F.col("total_po_value"), F.col("po_count")))


def spike_ratio() -> Column:
    base = F.col("avg_po_value")
    return F.when(base > 0, round_half_up(F.try_divide(F.col("total_amount"), base))).otherwise(F.lit(0.0))


def value_spike() -> Column:
    return flag(F.col("spike_ratio") > SPIKE_LIMIT)


def invoice_to_avg_ratio() -> Column:
    return safe_ratio(F.col("total_amount"), F.col("avg_po_value"))


def high_value_invoice_flag() -> Column:
    return flag(F.col("total_amount") > HIGH_VALUE_ABOVE)


# --- names, directors, invoices -----------------------------------------------------
def name_mismatch() -> Column:
    return flag(F.col("name_sim_score") < NAME_MATCH_FLOOR)


def director_overlap_flag() -> Column:
    return flag(F.col("director_vendor_count") > 1)


def duplicate_invoice() -> Column:
    return flag(F.col("invoice_dup_count") > 1)


def late_invoice() -> Column:
    return flag(days_between(F.col("invoice_date"), F.col("po_date")) > LATE_AFTER_DAYS)


def is_march_invoice() -> Column:
    return flag(F.month("invoice_date") == 3)


def missing_ewb() -> Column:
    return flag((F.col("total_amount") > EWB_REQUIRED_ABOVE) & F.col("ewb_number").isNull())


# --- vendor behaviour ---------------------------------------------------------------
def filings_made() -> Column:
    return reduce(add, [F.col(q) for q in FILING_QUARTERS])


def filing_compliance_rate() -> Column:
    return filings_made() / len(FILING_QUARTERS)


def vendor_non_filer() -> Column:
    return flag(filings_made() < FILINGS_REQUIRED)


def vendor_age_days(as_of: str | None = None) -> Column:
    return days_between(as_of_date(as_of), F.col("registration_date"))


# --- score and bands ----------------------------------------------------------------
def rule_fail_count(flags: list[str] = RULE_FLAGS) -> Column:
    return reduce(add, [F.col(f) for f in flags])


def rule_score(flags: list[str] = RULE_FLAGS) -> Column:
    return F.round((F.lit(1) - F.col("rule_fail_count") / len(flags)) * 100, 2)


def severity_dashboard() -> Column:
    return band(F.col("rule_fail_count"), SEVERITY_BANDS, LOWEST_BAND)


def vendor_risk_tier() -> Column:
    return band(F.col("anomaly_rate"), VENDOR_TIER_BANDS, LOWEST_BAND)


# --- counts over groups of rows -----------------------------------------------------
def add_duplicate_counts(
    df: DataFrame, source: DataFrame | None = None, null_invoice: str = "group", **options
) -> DataFrame:
    """Rows that share registration, invoice number, year and month.

    Orders without an invoice share the missing number: "group" counts them together,
    "ignore" gives them a count of 0.
    """
    out = count_within(df, DUPLICATE_KEYS, "invoice_dup_count", ["po_id"], source, **options)
    if null_invoice == "ignore":
        kept = F.when(F.col("invoice_number").isNotNull(), F.col("invoice_dup_count"))
        out = out.withColumn("invoice_dup_count", F.coalesce(kept, F.lit(0).cast("bigint")))
    return out


def add_same_day_counts(df: DataFrame, source: DataFrame | None = None, **options) -> DataFrame:
    return count_within(
        df, SAME_DAY_KEYS, "invoice_count_same_vendor_same_day", ["po_id"], source, **options
    )


def add_vendor_frequency(df: DataFrame, source: DataFrame | None = None, **options) -> DataFrame:
    return count_within(df, ["vendor_id"], "vendor_po_frequency", ["po_id"], source, **options)
