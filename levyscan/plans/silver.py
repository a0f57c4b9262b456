"""The wide order table: one row per purchase order with vendor, invoice, rate, history,
label, rule flags, score and model features.

Shape of the plan. Orders, invoices and labels are laid out by the order id, one exchange
each, and join from there on without another. Everything that hangs on the vendor (blacklist,
shared directors, order frequency, spending history) is joined at the grain of vendor and
month, a table far smaller than the orders. What hangs on groups of orders or on other keys
(both group sizes, the rate, the name score) is found on a narrow sheet of key columns and
comes back by the order id. So the wide rows are moved at most twice: into the layout, and to
the vendor's profile where that is too large to broadcast. Of many orders they are moved once:
the profile is then joined to the sheet.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyscan.functions.scalars import parse_date, year_month
from levyscan.operators import rules
from levyscan.operators.aggregates import merge_history
from levyscan.operators.keyed import (
    attach_director_counts,
    key_counts,
    left_join_on,
    lookup_join,
    member_flag,
    one_per_key,
    repeated_keys,
    shared_groups,
)
from levyscan.operators.names import score_pairs, with_name_similarity
from levyscan.operators.projection import (
    bind_labels,
    default_labels,
    enforce_types,
    prepare_vendor_side,
)
from levyscan.plans.bronze import Layer
from levyscan.sources.layout import laid_out
from levyscan.sources.staging import Jobs, stage

MONTH_KEYS = ["vendor_id", "year_month"]


def invoice_per_order(invoices: DataFrame) -> DataFrame:
    """One invoice per order: the earliest by its real date, one without a date last."""
    dated = invoices.drop("ingestion_timestamp").withColumn("invoice_date", parse_date(F.col("invoice_date")))
    return one_per_key(dated, ["po_id"], prefer=["invoice_date"])


def attach_vendor(orders: DataFrame, vendors: DataFrame, **options) -> DataFrame:
    """Vendor master on the vendor id."""
    side = one_per_key(prepare_vendor_side(vendors), ["vendor_id"])
    return lookup_join(orders, side, ["vendor_id"], ["po_id"], bound=vendors, **options)


def attach_invoice(orders: DataFrame, invoices: DataFrame) -> DataFrame:
    return orders.join(invoice_per_order(invoices), "po_id", "left")


def rate_per_code(rates: DataFrame) -> DataFrame:
    return one_per_key(
        rates.select("hsn_code", F.col("gst_rate").try_cast("double").alias("gst_rate")), ["hsn_code"]
    )


def attach_rate(orders: DataFrame, rates: DataFrame, **options) -> DataFrame:
    return lookup_join(orders, rate_per_code(rates), ["hsn_code"], ["po_id"], bound=rates, **options)


def attach_history(
    orders: DataFrame, history: DataFrame, history_value_is: str = "average", **options
) -> DataFrame:
    """Spending history on vendor and month."""
    merged = merge_history(history, history_value_is)
    return lookup_join(orders, merged, MONTH_KEYS, ["po_id"], bound=history, **options)


def label_per_order(labels: DataFrame) -> DataFrame:
    """One label per order; where it has several, one that names an anomaly wins over CLEAN."""
    return one_per_key(bind_labels(labels), ["po_id"], prefer=[-F.col("is_anomalous"), "anomaly_code"])


def attach_labels(orders: DataFrame, labels: DataFrame) -> DataFrame:
    return orders.join(label_per_order(labels), "po_id", "left")


def vendor_month_profile(
    vendors: DataFrame, blacklist: DataFrame, history: DataFrame, month_counts: DataFrame, **options
) -> DataFrame:
    """All vendor facts per (vendor, month) that occurs in the orders. `vendors` has one row
    per vendor, `history` one per vendor and month."""
    frequency = month_counts.groupBy("vendor_id").agg(F.sum("n").alias("vendor_po_frequency"))
    ordering = vendors.join(frequency.select("vendor_id"), "vendor_id", "left_semi")
    listed = member_flag(ordering, blacklist, ["gstin"], "blacklisted", ["vendor_id"], **options)
    pans = ordering.select("vendor_id", "director_pan_1")
    master = attach_director_counts(listed, pans, bound=vendors, **options)
    # A vendor has at most one row per calendar month here, so these joins cannot skew.
    by_month = month_counts.select(*MONTH_KEYS).join(frequency, "vendor_id")
    return left_join_on(by_month.join(master, "vendor_id", "left"), history, MONTH_KEYS)


#: From so many orders on the wide rows are not moved to the vendor's profile.
MANY_ORDERS = 1_000_000

#: Columns of an order that joins and rules read; the others are only passed on.
ORDER_INPUTS = [
    "po_id", "po_date", "year", "month", *MONTH_KEYS, "hsn_code", "buyer_gstin", "buyer_state", "invoice_billing_name",
    "cgst_rate", "sgst_rate", "igst_rate", "total_amount", "ewb_number", "ewb_generated_date",
]

#: What an order takes from the narrow sheet.
FACTS = ["gst_rate", "invoice_dup_count", "invoice_count_same_vendor_same_day", "name_sim_score"]


class _SheetFacts:
    """What the narrow sheet tells about groups of orders and about names, each written by a
    job of its own."""

    def __init__(self, sheet: DataFrame, jobs: Jobs):
        self._duplicates = jobs.start(lambda: shared_groups(sheet, rules.DUPLICATE_KEYS))
        self._same_day = jobs.start(lambda: shared_groups(sheet, rules.SAME_DAY_KEYS))
        self._names = jobs.start(lambda: score_pairs(sheet, "invoice_billing_name", "trade_name"))

    def attach(self, rows: DataFrame, schedule: DataFrame, null_invoice: str, **options) -> DataFrame:
        """Rate, group sizes and name score for rows that have the sheet's columns. `schedule`
        has one row per code."""
        rated = lookup_join(rows, schedule, ["hsn_code"], ["po_id"], **options)
        counted = rules.add_duplicate_counts(rated, None, null_invoice, groups=self._duplicates.result(), **options)
        counted = rules.add_same_day_counts(counted, None, groups=self._same_day.result(), **options)
        names = {"identity": ["po_id"], "scores": self._names.result(), **options}
        return with_name_similarity(counted, "invoice_billing_name", "trade_name", "name_sim_score", **names)


def build_silver(
    bronze: Layer,
    as_of: str | None = None,
    history_value_is: str = "average",
    null_invoice: str = "group",
    many_orders: int = MANY_ORDERS,
    columns: list[str] | None = None,
    **options,
) -> DataFrame:
    """The wide table, or only the `columns` asked for: order columns that neither they nor the
    rules need are then not written on the way. `options` (broadcast_rows, rows_per_salt) reach
    every lookup.

    Orders, invoices and labels are laid out by the order id; the vendor profile, the narrow
    sheet and the groups and name pairs found in it are written on the way, side by side where
    one does not need the other. From `many_orders` on the profile is joined to the sheet and
    comes home with its facts, so that the wide rows stay in their buckets. Where order ids
    repeat, the facts of the sheet are attached to the rows themselves in place of by id.
    """
    dated = enforce_types(bronze.purchase_orders).withColumn("year_month", year_month(F.col("po_date")))
    if columns is not None:
        dated = dated.select(*[c for c in dated.columns if c in ORDER_INPUTS or c in columns])

    def sheet_table(orders: DataFrame, invoices: DataFrame, vendors: DataFrame, month_counts: DataFrame) -> DataFrame:
        columns = ["po_id", "year", "month", *MONTH_KEYS, "hsn_code", "invoice_billing_name"]
        keys = orders.select(*columns).join(invoices.select("po_id", "invoice_number", "invoice_date"), "po_id", "left")
        per_vendor = month_counts.groupBy("vendor_id").agg(F.sum("n").alias("n"))
        names = vendors.select("vendor_id", "gstin", "trade_name")
        return stage(lookup_join(keys, names, ["vendor_id"], ["po_id"], per_vendor, **options), "order-sheet")

    def profile_table(vendors: DataFrame, history: DataFrame, month_counts: DataFrame) -> DataFrame:
        profile = vendor_month_profile(vendors, bronze.cbic_blacklist, history, month_counts, **options)
        return stage(profile, "vendor-profile")

    with Jobs(dated.sparkSession) as jobs:
        laid = jobs.start(lambda: laid_out(dated, "po_id", "orders"))
        billed = jobs.start(lambda: laid_out(invoice_per_order(bronze.vendor_invoices), "po_id", "invoices"))
        master = jobs.start(lambda: stage(one_per_key(prepare_vendor_side(bronze.vendors), ["vendor_id"]), "vendors"))
        spent = jobs.start(lambda: stage(merge_history(bronze.historical_po_values, history_value_is), "history"))
        named = jobs.start(lambda: laid_out(label_per_order(bronze.ground_truth), "po_id", "labels"))
        rated = jobs.start(lambda: stage(rate_per_code(bronze.hsn_rate_schedule), "rates"))
        orders, vendors = laid.result(), master.result()
        month_counts = stage(key_counts(orders, MONTH_KEYS), "vendor-months")
        profiled = jobs.start(lambda: profile_table(vendors, spent.result(), month_counts))
        unique = jobs.start(lambda: repeated_keys(orders, ["po_id"]).isEmpty())
        invoices = billed.result()
        sheet = sheet_table(orders, invoices, vendors, month_counts)
        facts = _SheetFacts(sheet, jobs)
        labelled = orders.join(invoices, "po_id", "left").join(named.result(), "po_id", "left")
        schedule = rated.result()

        def with_profile(frame: DataFrame) -> DataFrame:
            return lookup_join(frame, profiled.result(), MONTH_KEYS, ["po_id"], month_counts, null_safe=True, **options)

        if not unique.result():
            wide = facts.attach(with_profile(labelled), schedule, null_invoice, **options)
        elif orders.count() >= many_orders:
            told = facts.attach(sheet, schedule, null_invoice, **options).select("po_id", *MONTH_KEYS, *FACTS)
            wide = labelled.join(with_profile(told).drop(*MONTH_KEYS), "po_id", "left")
        else:
            found = facts.attach(sheet, schedule, null_invoice, **options).select("po_id", *FACTS)
            wide = with_profile(labelled.join(found, "po_id", "left"))
    scored = with_score(with_row_rules(wide, as_of))
    return scored if columns is None else scored.select(*columns)


def with_row_rules(wide: DataFrame, as_of: str | None = None) -> DataFrame:
    """Rules and features that need nothing but their own row."""
    wide = wide.withColumns(
        {
            "is_gstin_valid": rules.is_gstin_valid(),
            "gst_state_code": rules.gst_state_code(),
            "gst_state_name": rules.gst_state_name(),
            "state_mismatch": rules.state_mismatch(),
            "blacklisted": F.coalesce("blacklisted", F.lit(0)),
            "actual_gst_rate": rules.actual_gst_rate(),
            "rate_mismatch": rules.rate_mismatch(),
            "hsn_rate_delta": rules.hsn_rate_delta(),
            "avg_po_value": rules.avg_po_value(),
            "director_overlap_flag": rules.director_overlap_flag(),
            "late_invoice": rules.late_invoice(),
            "filing_compliance_rate": rules.filing_compliance_rate(),
            "vendor_non_filer": rules.vendor_non_filer(),
            "missing_ewb": rules.missing_ewb(),
            "registration_date": parse_date(F.col("registration_date")),
            "ewb_generated_date": parse_date(F.col("ewb_generated_date")),
            "is_march_invoice": rules.is_march_invoice(),
            "high_value_invoice_flag": rules.high_value_invoice_flag(),
        }
    )
    wide = wide.withColumns(
        {
            "spike_ratio": rules.spike_ratio(),
            "invoice_to_avg_ratio": rules.invoice_to_avg_ratio(),
            "name_mismatch": rules.name_mismatch(),
            "vendor_age_days": rules.vendor_age_days(as_of),
        }
    )
    return default_labels(wide.withColumn("value_spike", rules.value_spike()))


def with_score(counted: DataFrame) -> DataFrame:
    flagged = counted.withColumn("duplicate_invoice", rules.duplicate_invoice())
    summed = flagged.withColumn("rule_fail_count", rules.rule_fail_count())
    return summed.withColumn("rule_score", rules.rule_score())
