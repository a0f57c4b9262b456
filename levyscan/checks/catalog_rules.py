"""Queries for aggregates, windows, ordering, scalar expressions, rules and layers."""

from pyspark.sql import functions as F

from levyscan.checks.registry import Inputs, check
from levyscan.checks.views import AS_OF, date_of, exact_avg, exact_sum, hash_fraction, hash_number, mark_flag, round2
from levyscan.constants import FILING_QUARTERS, GSTIN_PATTERN, RULE_FLAGS
from levyscan.functions import scalars
from levyscan.functions.similarity import name_similarity_builtin
from levyscan.operators.names import with_name_similarity
from levyscan.operators import aggregates, keyed, ordering, rules
from levyscan.plans import bronze, gold, silver

_MONTH = "strftime(po_date, '%Y-%m')"


# --- aggregates -----------------------------------------------------------------------
@check("ag1_history_from_orders", f"SELECT vendor_id, {_MONTH} AS year_month, {exact_avg('total_amount', 6)} AS total_po_value, count(*) AS po_count FROM bronze_orders GROUP BY ALL")
def _(t: Inputs):
    return aggregates.history_from_orders(t.orders)


@check("ag2_merge_history", "SELECT * FROM history_one")
def _(t: Inputs):
    return aggregates.merge_history(t.raw.historical_po_values)


@check(
    "ag2_merge_history_totals",
    f"""SELECT vendor_id, year_month, {exact_sum('total_po_value * po_count')} AS total_po_value, sum(po_count)::DOUBLE AS po_count
        FROM (SELECT * FROM raw_history UNION ALL SELECT * FROM raw_history WHERE po_count > 3) GROUP BY vendor_id, year_month""",
)
def _(t: Inputs):
    history = t.raw.historical_po_values
    return aggregates.merge_history(history.union(history.filter("po_count > 3")), "total")


@check("ag3_vendors_per_director", "SELECT director_pan_1, count(DISTINCT vendor_id) AS director_vendor_count FROM po_vendor GROUP BY director_pan_1")
def _(t: Inputs):
    return aggregates.vendors_per_director(t.orders_with_vendor)


@check("ag4_vendor_risk", "SELECT * EXCLUDE (risk_tier) FROM vendor_risk")
def _(t: Inputs):
    return aggregates.vendor_risk(t.silver)


@check("ag5_rate_summary", f"SELECT max(anomaly_rate) AS max_rate, min(anomaly_rate) AS min_rate, {exact_avg('anomaly_rate')} AS avg_rate FROM vendor_risk")
def _(t: Inputs):
    return aggregates.rate_summary(t.risk)


_PROFILED = ["severity", "anomaly_code", *RULE_FLAGS]


@check("ag6_frequencies", " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c}::VARCHAR AS value, count(*) AS n FROM silver GROUP BY {c}" for c in _PROFILED))
def _(t: Inputs):
    return aggregates.frequencies(t.silver, *_PROFILED)


@check("ag7_distinct_values", "SELECT DISTINCT buyer_state, place_of_supply FROM bronze_orders")
def _(t: Inputs):
    return aggregates.distinct_values(t.orders, "buyer_state", "place_of_supply")


@check("ag8_key_check", "SELECT count(*) AS n_rows, count(DISTINCT po_id) AS n_keys FROM raw_invoices")
def _(t: Inputs):
    return aggregates.key_check(t.raw.vendor_invoices, "po_id")


_NULLABLE = ["vendor_id", "hsn_code", "ewb_number", "invoice_billing_name", "buyer_state", "cgst_rate"]


@check("ag9_null_profile", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM raw_orders" for c in _NULLABLE))
def _(t: Inputs):
    return aggregates.null_profile(t.raw.purchase_orders.select(*_NULLABLE))


@check(
    "ag10_one_per_key",
    """SELECT po_id, invoice_date, invoice_number, gstr2b_itc_available, itc_claimed_by_buyer
       FROM (SELECT *, row_number() OVER (PARTITION BY po_id ORDER BY itc_claimed_by_buyer, invoice_date) AS rn FROM raw_invoices) WHERE rn = 1""",
)
def _(t: Inputs):
    return keyed.one_per_key(t.raw.vendor_invoices, ["po_id"], prefer=["itc_claimed_by_buyer"])


@check("ag11_distinct_key", "SELECT DISTINCT gstin FROM raw_blacklist")
def _(t: Inputs):
    return aggregates.distinct_values(t.raw.cbic_blacklist, "gstin")


@check(
    "ag12_layer_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {view}"
        for name, view in [("vendors", "raw_vendors"), ("purchase_orders", "raw_orders"), ("bronze_purchase_orders", "bronze_orders"),
                           ("vendor_invoices", "raw_invoices"), ("hsn_rate_schedule", "raw_rates"), ("cbic_blacklist", "raw_blacklist"),
                           ("historical_po_values", "raw_history"), ("ground_truth", "raw_labels")]
    ),
)
def _(t: Inputs):
    names = bronze.Layer.__dataclass_fields__
    tables = {name: getattr(t.raw, name) for name in names}
    return aggregates.layer_counts({**tables, "bronze_purchase_orders": t.orders})


@check(
    "ag13_executive_kpis",
    f"""SELECT count(*) AS total_pos, {exact_sum('total_amount')} AS total_po_value, sum(is_anomalous)::BIGINT AS total_anomalies,
               (SELECT count(*) FROM vendor_risk WHERE risk_tier IN ('Critical', 'High')) AS high_risk_vendors,
               sum(is_anomalous)::DOUBLE / count(*) AS anomaly_rate FROM silver""",
)
def _(t: Inputs):
    return aggregates.executive_kpis(t.silver, t.risk)


@check("ag14_compliance_by_tier", f"SELECT risk_tier, count(*) AS n_vendors, {exact_avg('filing_compliance_rate')} AS avg_compliance FROM vendor_risk GROUP BY risk_tier")
def _(t: Inputs):
    return aggregates.compliance_by_tier(t.risk)


# --- windows, numbering ---------------------------------------------------------------
@check("wn1_duplicate_count", "SELECT po_id, invoice_dup_count FROM counted")
def _(t: Inputs):
    rows = silver.attach_invoice(t.orders_with_vendor, t.raw.vendor_invoices)
    return rules.add_duplicate_counts(rows).select("po_id", "invoice_dup_count")


@check("wn2_same_day_count", "SELECT po_id, invoice_count_same_vendor_same_day FROM counted")
def _(t: Inputs):
    return rules.add_same_day_counts(t.orders_with_invoice).select("po_id", "invoice_count_same_vendor_same_day")


@check("wn3_vendor_frequency", "SELECT po_id, count(po_id) OVER (PARTITION BY vendor_id) AS vendor_po_frequency FROM bronze_orders")
def _(t: Inputs):
    return rules.add_vendor_frequency(t.orders).select("po_id", "vendor_po_frequency")


@check("wn4_sequential_ids", "SELECT po_id, printf('PO%07d', row_number() OVER (ORDER BY po_date, po_id)) AS new_po_id FROM bronze_orders")
def _(t: Inputs):
    numbered = ordering.number_rows(t.orders.select("po_id", "po_date"), ["po_date", "po_id"], "nth")
    return numbered.select("po_id", scalars.padded_id("PO", F.col("nth"), 7).alias("new_po_id"))


@check("wn5_lookup_numbers", "SELECT vendor_id, row_number() OVER (ORDER BY vendor_id) AS rn FROM raw_vendors")
def _(t: Inputs):
    return ordering.number_rows(t.raw.vendors.select("vendor_id"), ["vendor_id"], "rn")


@check("wn6_fixed_clusters", "SELECT vendor_id, ((row_number() OVER (ORDER BY vendor_id) - 1) // 4) AS cluster_id FROM raw_vendors")
def _(t: Inputs):
    return ordering.fixed_size_clusters(t.raw.vendors.select("vendor_id"), ["vendor_id"], 4, "cluster_id")


# --- ordering -------------------------------------------------------------------------
@check("st1_top_suspicious", "SELECT po_id, vendor_id, rule_score, severity FROM silver WHERE rule_score < 70 ORDER BY rule_score DESC, po_id LIMIT 50")
def _(t: Inputs):
    return ordering.top_suspicious(t.silver).select("po_id", "vendor_id", "rule_score", "severity")


@check("st2_least_similar_names", "SELECT po_id, invoice_billing_name, trade_name, name_sim_score FROM silver ORDER BY name_sim_score, po_id LIMIT 20")
def _(t: Inputs):
    return ordering.top_k(_scored(t).select("po_id", "invoice_billing_name", "trade_name", "name_sim_score"), 20, "name_sim_score", "po_id")


@check("st3_ordered_counts", "SELECT anomaly_code, count(*) AS n FROM raw_labels GROUP BY 1 ORDER BY 2 DESC, 1")
def _(t: Inputs):
    return ordering.ordered_counts(t.raw.ground_truth, "anomaly_code")


@check("st3_ordered_by_value", "SELECT rule_score, count(*) AS n FROM silver GROUP BY 1 ORDER BY 1")
def _(t: Inputs):
    return ordering.ordered_counts(t.silver, "rule_score", by_value=True)


@check(
    "st4_rank_within",
    """SELECT risk_tier, vendor_id, row_number() OVER (PARTITION BY risk_tier ORDER BY total_po_value DESC, vendor_id) AS place FROM vendor_risk""",
)
def _(t: Inputs):
    ranked = ordering.rank_within(t.risk, "risk_tier", [F.desc("total_po_value"), F.col("vendor_id")], "place")
    return ranked.select("risk_tier", "vendor_id", "place")


@check("st5_top_risk_vendors", "SELECT vendor_id, anomaly_rate, risk_tier FROM vendor_risk ORDER BY anomaly_rate DESC, vendor_id LIMIT 10")
def _(t: Inputs):
    return ordering.top_k(t.risk.select("vendor_id", "anomaly_rate", "risk_tier"), 10, F.desc("anomaly_rate"), "vendor_id")


@check("st6_sample_fraction", f"SELECT po_id FROM raw_orders WHERE {hash_fraction('sample', 'po_id')} < 0.05")
def _(t: Inputs):
    return ordering.sample_fraction(t.raw.purchase_orders, 0.05, "sample", "po_id").select("po_id")


@check("st6_sample_rows", f"SELECT po_id FROM raw_orders ORDER BY {hash_number('draw', 'po_id')}, po_id LIMIT 240")
def _(t: Inputs):
    return ordering.sample_rows(t.raw.purchase_orders.select("po_id"), 240, "draw", "po_id")


# --- scalar expressions ---------------------------------------------------------------
@check("sc1_gstin_valid", f"SELECT vendor_id, regexp_matches(gstin, '{GSTIN_PATTERN}') AS is_valid FROM raw_vendors")
def _(t: Inputs):
    return t.raw.vendors.select("vendor_id", scalars.gstin_is_valid(F.col("gstin")).alias("is_valid"))


@check("sc2_state_code", "SELECT po_id, substr(buyer_gstin, 1, 2) AS code FROM raw_orders")
def _(t: Inputs):
    return t.raw.purchase_orders.select("po_id", scalars.state_code(F.col("buyer_gstin")).alias("code"))


@check("sc3_state_name", "SELECT c_custkey, state_name FROM customer LEFT JOIN state_names ON code = (c_custkey % 60)::VARCHAR")
def _(t: Inputs):
    keys = t.table("customer")
    return keys.select("c_custkey", scalars.state_name((F.col("c_custkey") % 60).cast("string")).alias("state_name"))


@check("sc4_differs_ignoring_case", "SELECT po_id, lower(invoice_billing_name) <> lower(po_vendor_name) AS differs FROM raw_orders")
def _(t: Inputs):
    differs = scalars.differs_ignoring_case(F.col("invoice_billing_name"), F.col("po_vendor_name"))
    return t.raw.purchase_orders.select("po_id", differs.alias("differs"))


@check("sc5_parse_date", f"SELECT po_id, {date_of('invoice_date')} AS invoice_date FROM raw_invoices")
def _(t: Inputs):
    return t.raw.vendor_invoices.select("po_id", scalars.parse_date(F.col("invoice_date")).alias("invoice_date"))


@check("sc6_date_parts", f"SELECT po_id, year(po_date)::INTEGER AS y, month(po_date)::INTEGER AS m, {_MONTH} AS ym FROM bronze_orders")
def _(t: Inputs):
    day = F.col("po_date")
    return t.orders.select("po_id", F.year(day).alias("y"), F.month(day).alias("m"), scalars.year_month(day).alias("ym"))


@check("sc7_date_arithmetic", f"SELECT po_id, date_diff('day', po_date, DATE '{AS_OF}')::INTEGER AS age, (po_date - 30) AS month_before FROM bronze_orders")
def _(t: Inputs):
    day = F.col("po_date")
    age = scalars.days_between(scalars.as_of_date(AS_OF), day)
    return t.orders.select("po_id", age.alias("age"), F.date_sub(day, 30).alias("month_before"))


@check("sc8_safe_ratio", "SELECT po_id, CASE WHEN igst_rate > 0 THEN base_amount / igst_rate ELSE 0.0::DOUBLE END AS ratio FROM raw_orders")
def _(t: Inputs):
    return t.raw.purchase_orders.select("po_id", scalars.safe_ratio(F.col("base_amount"), F.col("igst_rate")).alias("ratio"))


@check("sc9_rounding", f"SELECT po_id, {round2('total_amount / 7.0::DOUBLE')} AS seventh, abs(cgst_rate - sgst_rate) AS gap FROM raw_orders")
def _(t: Inputs):
    seventh = scalars.round_half_up(F.col("total_amount") / F.lit(7.0))
    return t.raw.purchase_orders.select("po_id", seventh.alias("seventh"), F.abs(F.col("cgst_rate") - F.col("sgst_rate")).alias("gap"))


@check("sc10_band", "SELECT po_id, CASE WHEN total_amount >= 500000 THEN 'large' WHEN total_amount >= 50000 THEN 'medium' ELSE 'small' END AS size FROM raw_orders")
def _(t: Inputs):
    size = scalars.band(F.col("total_amount"), [(500000, "large"), (50000, "medium")], "small")
    return t.raw.purchase_orders.select("po_id", size.alias("size"))


@check("sc11_mark_to_flag", f"SELECT vendor_id, {', '.join(f'{mark_flag(q)} AS {q}' for q in FILING_QUARTERS)} FROM raw_vendors")
def _(t: Inputs):
    return t.raw.vendors.select("vendor_id", *[scalars.mark_to_flag(F.col(q)).alias(q) for q in FILING_QUARTERS])


@check("sc12_remap_code", "SELECT po_id, CASE WHEN anomaly_code = 'FRD-006' THEN 'FRD-002' ELSE anomaly_code END AS anomaly_code FROM raw_labels")
def _(t: Inputs):
    return t.raw.ground_truth.select("po_id", scalars.remap_code(F.col("anomaly_code")).alias("anomaly_code"))


@check("sc13_padded_id", "SELECT o_orderkey, printf('INV%08d', o_orderkey) AS narrow, printf('T%02d', o_orderkey) AS wide FROM orders")
def _(t: Inputs):
    key = F.col("o_orderkey")
    orders = t.table("orders")
    return orders.select(key, scalars.padded_id("INV", key, 8).alias("narrow"), scalars.padded_id("T", key, 2).alias("wide"))


@check("sc14_length", "SELECT length(invoice_billing_name)::INTEGER AS name_length, count(*) AS n FROM raw_orders GROUP BY 1")
def _(t: Inputs):
    return keyed.key_counts(t.raw.purchase_orders.select(F.length("invoice_billing_name").alias("name_length")), ["name_length"])


# --- rules ----------------------------------------------------------------------------
@check("ru1_gstin_valid", f"SELECT po_id, regexp_matches(buyer_gstin, '{GSTIN_PATTERN}') AS is_gstin_valid FROM bronze_orders")
def _(t: Inputs):
    return t.orders.select("po_id", rules.is_gstin_valid().alias("is_gstin_valid"))


@check("ru2_state_mismatch", "SELECT po_id, gst_state_code, gst_state_name, state_mismatch FROM flagged")
def _(t: Inputs):
    return t.orders.select(
        "po_id",
        rules.gst_state_code().alias("gst_state_code"),
        rules.gst_state_name().alias("gst_state_name"),
        rules.state_mismatch().alias("state_mismatch"),
    )


@check("ru3_blacklisted", "SELECT po_id, blacklisted FROM flagged")
def _(t: Inputs):
    flagged = keyed.member_flag(t.orders_with_vendor, t.raw.cbic_blacklist, ["gstin"], "blacklisted", ["po_id"])
    return flagged.select("po_id", "blacklisted")


@check("ru4_rate_mismatch", "SELECT po_id, actual_gst_rate, rate_mismatch FROM flagged")
def _(t: Inputs):
    rated = silver.attach_rate(t.orders, t.raw.hsn_rate_schedule)
    return rated.select("po_id", rules.actual_gst_rate().alias("actual_gst_rate"), rules.rate_mismatch().alias("rate_mismatch"))


def _with_spike(t: Inputs):
    keyed_orders = t.orders.withColumn("year_month", scalars.year_month(F.col("po_date")))
    rows = silver.attach_history(keyed_orders, t.raw.historical_po_values)
    rows = rows.withColumn("avg_po_value", rules.avg_po_value()).withColumn("spike_ratio", rules.spike_ratio())
    return rows.withColumn("value_spike", rules.value_spike())


@check("ru5_value_spike", "SELECT po_id, avg_po_value, spike_ratio, value_spike FROM counted")
def _(t: Inputs):
    return _with_spike(t).select("po_id", "avg_po_value", "spike_ratio", "value_spike")


def _scored(t: Inputs):
    rows = t.orders_with_vendor.select("po_id", "invoice_billing_name", "trade_name")
    return with_name_similarity(rows, "invoice_billing_name", "trade_name", "name_sim_score", ["po_id"])


@check("ru6_name_similarity", "SELECT po_id, name_sim_score FROM flagged")
def _(t: Inputs):
    return _scored(t).select("po_id", "name_sim_score")


@check("ru6_name_similarity_builtin", "SELECT a, b, score FROM pair_scores")
def _(t: Inputs):
    a, b = F.lower("invoice_billing_name").alias("a"), F.lower("trade_name").alias("b")
    pairs = t.orders_with_vendor.select(a, b).dropna().distinct()
    return pairs.withColumn("score", name_similarity_builtin(F.col("a"), F.col("b")))


@check("ru7_name_mismatch", "SELECT po_id, name_mismatch FROM flagged")
def _(t: Inputs):
    return _scored(t).select("po_id", rules.name_mismatch().alias("name_mismatch"))


@check("ru8_duplicate_invoice", "SELECT po_id, invoice_dup_count, duplicate_invoice FROM counted")
def _(t: Inputs):
    rows = silver.attach_invoice(t.orders_with_vendor, t.raw.vendor_invoices)
    counted = rules.add_duplicate_counts(rows)
    return counted.select("po_id", "invoice_dup_count", rules.duplicate_invoice().alias("duplicate_invoice"))


@check(
    "ru8_duplicate_invoice_ignoring_gaps",
    """SELECT po_id, n AS invoice_dup_count, CASE WHEN n > 1 THEN 1 ELSE 0 END AS duplicate_invoice
       FROM (SELECT po_id, CASE WHEN invoice_number IS NULL THEN 0 ELSE invoice_dup_count END AS n FROM counted)""",
)
def _(t: Inputs):
    rows = silver.attach_invoice(t.orders_with_vendor, t.raw.vendor_invoices)
    counted = rules.add_duplicate_counts(rows, null_invoice="ignore")
    return counted.select("po_id", "invoice_dup_count", rules.duplicate_invoice().alias("duplicate_invoice"))


@check("ru9_director_overlap", "SELECT po_id, director_vendor_count, director_overlap_flag FROM flagged")
def _(t: Inputs):
    rows = t.orders_with_vendor
    shared = aggregates.vendors_per_director(rows)
    joined = keyed.lookup_join(rows, shared, ["director_pan_1"], ["po_id"])
    return joined.select("po_id", "director_vendor_count", rules.director_overlap_flag().alias("director_overlap_flag"))


@check("ru10_late_invoice", "SELECT po_id, late_invoice FROM flagged")
def _(t: Inputs):
    return t.orders_with_invoice.select("po_id", rules.late_invoice().alias("late_invoice"))


_FILED = " + ".join(FILING_QUARTERS)


@check("ru11_filing_compliance", f"SELECT vendor_id, ({_FILED}) / 6.0::DOUBLE AS filing_compliance_rate FROM vendor_flags")
def _(t: Inputs):
    return t.vendor_flags.select("vendor_id", rules.filing_compliance_rate().alias("filing_compliance_rate"))


@check("ru12_vendor_non_filer", f"SELECT vendor_id, CASE WHEN {_FILED} < 4 THEN 1 ELSE 0 END AS vendor_non_filer FROM vendor_flags")
def _(t: Inputs):
    return t.vendor_flags.select("vendor_id", rules.vendor_non_filer().alias("vendor_non_filer"))


@check("ru13_missing_ewb", "SELECT po_id, CASE WHEN total_amount > 50000 AND ewb_number IS NULL THEN 1 ELSE 0 END AS missing_ewb FROM bronze_orders")
def _(t: Inputs):
    return t.orders.select("po_id", rules.missing_ewb().alias("missing_ewb"))


@check("ru14_rule_fail_count", "SELECT po_id, rule_fail_count FROM silver")
def _(t: Inputs):
    return t.silver.select("po_id", "rule_fail_count")


@check("ru15_rule_score", "SELECT po_id, rule_score FROM silver")
def _(t: Inputs):
    return t.silver.select("po_id", "rule_score")


@check("ru16_vendor_age", f"SELECT vendor_id, date_diff('day', {date_of('registration_date')}, DATE '{AS_OF}')::INTEGER AS vendor_age_days FROM raw_vendors")
def _(t: Inputs):
    dated = t.raw.vendors.withColumn("registration_date", scalars.parse_date(F.col("registration_date")))
    return dated.select("vendor_id", rules.vendor_age_days(AS_OF).alias("vendor_age_days"))


@check("ru17_march_invoice", "SELECT po_id, CASE WHEN month(invoice_date) = 3 THEN 1 ELSE 0 END AS is_march_invoice FROM bronze_orders LEFT JOIN invoice_one USING (po_id)")
def _(t: Inputs):
    return t.orders_with_invoice.select("po_id", rules.is_march_invoice().alias("is_march_invoice"))


@check("ru18_rate_delta", "SELECT po_id, hsn_rate_delta FROM flagged")
def _(t: Inputs):
    rated = silver.attach_rate(t.orders, t.raw.hsn_rate_schedule)
    return rated.select("po_id", rules.hsn_rate_delta().alias("hsn_rate_delta"))


@check("ru19_same_day_invoices", "SELECT po_id, vendor_id, invoice_date, invoice_count_same_vendor_same_day FROM flagged")
def _(t: Inputs):
    counted = rules.add_same_day_counts(t.orders_with_invoice)
    return counted.select("po_id", "vendor_id", "invoice_date", "invoice_count_same_vendor_same_day")


@check("ru20_vendor_frequency", "SELECT po_id, vendor_id, vendor_po_frequency FROM flagged")
def _(t: Inputs):
    return rules.add_vendor_frequency(t.orders).select("po_id", "vendor_id", "vendor_po_frequency")


@check("ru21_high_value", "SELECT po_id, CASE WHEN total_amount > 500000 THEN 1 ELSE 0 END AS high_value_invoice_flag FROM bronze_orders")
def _(t: Inputs):
    return t.orders.select("po_id", rules.high_value_invoice_flag().alias("high_value_invoice_flag"))


@check("ru22_invoice_to_avg", "SELECT po_id, invoice_to_avg_ratio FROM flagged")
def _(t: Inputs):
    return _with_spike(t).select("po_id", rules.invoice_to_avg_ratio().alias("invoice_to_avg_ratio"))


@check("ru23_severity_dashboard", "SELECT po_id, severity_dashboard FROM gold_flags")
def _(t: Inputs):
    return t.silver.select("po_id", rules.severity_dashboard().alias("severity_dashboard"))


@check(
    "ru24_risk_tier",
    """SELECT s AS vendor_key, rate AS anomaly_rate, CASE WHEN rate >= 0.20 THEN 'Critical' WHEN rate >= 0.10 THEN 'High' WHEN rate >= 0.05 THEN 'Medium' ELSE 'Low' END AS risk_tier
       FROM (SELECT o_custkey AS s, count(*) FILTER (o_orderkey % 50 < 3)::DOUBLE / count(*) AS rate FROM orders GROUP BY 1)""",
)
def _(t: Inputs):
    hit = F.count(F.when(F.col("o_orderkey") % 50 < 3, 1))
    rates = t.table("orders").groupBy(F.col("o_custkey").alias("vendor_key")).agg((hit / F.count("*")).alias("anomaly_rate"))
    return rates.withColumn("risk_tier", rules.vendor_risk_tier())


# --- layers ---------------------------------------------------------------------------
@check("pl1_bronze_orders", "SELECT * FROM bronze_orders")
def _(t: Inputs):
    return bronze.bronze_purchase_orders(t.raw.purchase_orders, AS_OF)


@check("pl2_bronze_vendors", "SELECT * FROM bronze_vendors")
def _(t: Inputs):
    return bronze.bronze_vendors(t.raw.vendors, AS_OF)


@check("pl3_silver", "SELECT * FROM silver")
def _(t: Inputs):
    return t.silver


@check("pl4_gold_flags", f"SELECT *, TIMESTAMP '{AS_OF} 00:00:00' AS gold_created_ts FROM gold_flags")
def _(t: Inputs):
    return t.flags


@check("pl5_gold_vendor_risk", "SELECT * FROM vendor_risk")
def _(t: Inputs):
    return gold.gold_vendor_risk(t.silver)
