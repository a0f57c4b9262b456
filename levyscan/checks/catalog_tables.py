"""Queries for sources, sinks, projections, filters, nulls, joins and set operations."""

import uuid
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from levyscan.checks.registry import Inputs, check
from levyscan.checks.views import AS_OF, columns_of, hash_fraction
from levyscan.constants import BOOSTED_NAME, FEATURES, FILING_QUARTERS, FOREST_NAME, RULE_FLAGS
from levyscan.functions import scalars
from levyscan.operators import aggregates, evaluation, expansion, keyed, models, projection, setops
from levyscan.operators.casework import attach_vendor_risk
from levyscan.plans import bronze, gold, jobs, silver
from levyscan.schemas import INPUT_FIELDS, ORDER_FIELDS, VENDOR_FIELDS, raw_schema
from levyscan.sources import files, published
from levyscan.sources.staging import new_path, stage

_VENDOR_COLUMNS = [name for _, name, _ in VENDOR_FIELDS]


def _raw_headers(df, fields):
    return df.select(*[F.col(name).cast("string").alias(header) for header, name, _ in fields])


# --- sources and sinks --------------------------------------------------------------
@check("src1_read_csv", "SELECT * FROM raw_vendors")
def _(t: Inputs):
    path = files.export_csv(_raw_headers(t.raw.vendors, VENDOR_FIELDS), new_path(t.spark, "csv"))
    return projection.standardise(files.read_csv(t.spark, path, raw_schema(VENDOR_FIELDS)), VENDOR_FIELDS)


@check("src2_read_layer", "SELECT * FROM lineitem")
def _(t: Inputs):
    return files.read_layer(t.spark, t.base, "lineitem.parquet")


@check("src3_read_table", "SELECT vendor_id, trade_name, gstin FROM raw_vendors")
def _(t: Inputs):
    t.raw.vendors.createOrReplaceTempView("vendor_master")
    return files.read_table(t.spark, "vendor_master").select("vendor_id", "trade_name", "gstin")


@check("snk1_write_layer", "SELECT * FROM raw_invoices")
def _(t: Inputs):
    base = new_path(t.spark, "layer")
    files.write_layer(t.raw.vendor_invoices, base, "vendor_invoices")
    return files.read_layer(t.spark, base, "vendor_invoices")


@check("snk2_write_partitioned", "SELECT po_id, vendor_id, total_amount, year, month FROM bronze_orders")
def _(t: Inputs):
    slim = t.orders.select("po_id", "vendor_id", "total_amount", "year", "month")
    path = files.write_partitioned(slim, new_path(t.spark, "by-month"), "year", "month")
    return t.spark.read.schema(slim.schema).parquet(path)


@check("snk3_save_table", "SELECT hsn_code, description, gst_rate FROM raw_rates")
def _(t: Inputs):
    name = files.save_table(t.raw.hsn_rate_schedule, f"rate_schedule_{uuid.uuid4().hex}")
    return files.read_table(t.spark, name).select("hsn_code", "description", "gst_rate")


@check("snk4_export_csv", "SELECT * FROM scores WHERE model_name = 'XGBoost' AND prediction = 1")
def _(t: Inputs):
    picked = t.scores_of("XGBoost").filter("prediction = 1")
    path = files.export_csv(picked, new_path(t.spark, "export"))
    text = StructType([StructField(c, StringType()) for c in picked.columns])
    fields = [(c, c, kind) for c, kind in picked.dtypes]
    return projection.standardise(files.read_csv(t.spark, path, text), fields)


# --- projection -----------------------------------------------------------------------
@check("prj1_standardise", "SELECT * FROM raw_orders")
def _(t: Inputs):
    return projection.standardise(_raw_headers(t.raw.purchase_orders, ORDER_FIELDS), ORDER_FIELDS)


@check(
    "prj2_enforce_types",
    """SELECT po_id, quantity, base_amount, cgst_rate, sgst_rate, igst_rate, cgst_amt, sgst_amt, igst_amt, cess_amt,
              CASE WHEN quantity = 7 THEN NULL ELSE total_amount END AS total_amount FROM raw_orders""",
)
def _(t: Inputs):
    text = t.raw.purchase_orders.select("po_id", *[F.col(c).cast("string") for c in projection.ORDER_NUMBERS])
    broken = text.withColumn("total_amount", F.when(F.col("quantity") == "7", "n/a").otherwise(F.col("total_amount")))
    return projection.enforce_types(broken)


@check("prj3_whole_number", "SELECT po_id, CASE WHEN quantity % 10 = 3 THEN NULL ELSE quantity END AS quantity FROM raw_orders")
def _(t: Inputs):
    text = F.when(F.col("quantity") % 10 == 3, "many").otherwise(F.concat(F.col("quantity").cast("string"), F.lit(".0")))
    return t.raw.purchase_orders.select("po_id", scalars.whole_number(text).alias("quantity"))


@check("prj4_vendor_side", "SELECT vendor_id, status AS vendor_status, s_suppkey AS vendor_row_id FROM raw_vendors JOIN supplier ON s_name = trade_name")
def _(t: Inputs):
    ids = t.table("supplier").select(F.col("s_name").alias("trade_name"), F.col("s_suppkey").alias("id"))
    vendors = projection.with_audit_timestamp(t.raw.vendors, "ingestion_timestamp", AS_OF).join(ids, "trade_name")
    return projection.prepare_vendor_side(vendors).select("vendor_id", "vendor_status", "vendor_row_id")


@check("prj5_disambiguate", "SELECT vendor_id AS vendor_id_0, gstin, vendor_id AS vendor_id_2 FROM raw_vendors")
def _(t: Inputs):
    twice = t.raw.vendors.select("vendor_id", "gstin", "vendor_id")
    return projection.disambiguate_columns(twice)


@check("prj6_bind_labels", "SELECT po_id, anomaly_code, is_anomalous, severity FROM raw_labels")
def _(t: Inputs):
    shuffled = t.raw.ground_truth.select("severity", F.col("is_anomalous").cast("string"), "po_id", "anomaly_code")
    return projection.bind_labels(shuffled)


@check("prj7_audit_timestamp", f"SELECT vendor_id, TIMESTAMP '{AS_OF} 00:00:00' AS ingestion_timestamp FROM raw_vendors")
def _(t: Inputs):
    return projection.with_audit_timestamp(t.raw.vendors.select("vendor_id"), "ingestion_timestamp", AS_OF)


# --- filters --------------------------------------------------------------------------
@check("flt1_require_keys", "SELECT po_id, vendor_id FROM raw_orders WHERE po_id IS NOT NULL AND vendor_id IS NOT NULL")
def _(t: Inputs):
    return projection.require_keys(t.raw.purchase_orders, "po_id", "vendor_id").select("po_id", "vendor_id")


@check("flt2_keep_prefix", "SELECT 'PO-' || vendor_id AS po_id FROM raw_vendors WHERE status = 'Active'")
def _(t: Inputs):
    mark = F.when(F.col("status") == "Active", "PO-").otherwise("Section ")
    return projection.keep_prefix(t.raw.vendors.select(F.concat(mark, "vendor_id").alias("po_id")), "po_id", "PO-")


@check("flt3_suspicious", "SELECT po_id, rule_score FROM silver WHERE rule_score < 70")
def _(t: Inputs):
    return projection.keep_matching(t.silver, F.col("rule_score") < 70, "po_id", "rule_score")


@check("flt4_invalid_gstin", f"SELECT po_id, buyer_gstin FROM bronze_orders WHERE NOT regexp_matches(buyer_gstin, '{scalars.GSTIN_PATTERN}')")
def _(t: Inputs):
    return projection.keep_matching(t.orders, ~scalars.gstin_is_valid(F.col("buyer_gstin")), "po_id", "buyer_gstin")


@check("flt4_missing_history", "SELECT o.po_id, o.vendor_id FROM bronze_orders o LEFT JOIN history_one h ON h.vendor_id = o.vendor_id AND h.year_month = strftime(po_date, '%Y-%m') WHERE h.po_count IS NULL")
def _(t: Inputs):
    keyed_orders = t.orders.withColumn("year_month", scalars.year_month(F.col("po_date")))
    joined = silver.attach_history(keyed_orders, t.raw.historical_po_values)
    return projection.keep_matching(joined, F.col("po_count").isNull(), "po_id", "vendor_id")


@check("flt4_missing_rate", "SELECT r.po_id, r.hsn_code FROM raw_orders r LEFT JOIN raw_rates USING (hsn_code) WHERE gst_rate IS NULL")
def _(t: Inputs):
    joined = silver.attach_rate(t.raw.purchase_orders, t.raw.hsn_rate_schedule)
    return projection.keep_matching(joined, F.col("gst_rate").isNull(), "po_id", "hsn_code")


@check("flt5_repeated_keys", "SELECT po_id, count(*) AS n FROM raw_invoices GROUP BY po_id HAVING count(*) > 1")
def _(t: Inputs):
    return keyed.repeated_keys(t.raw.vendor_invoices, ["po_id"])


@check("flt6_false_positives", "SELECT model_name, po_id, probability FROM scores WHERE label = 0 AND prediction = 1")
def _(t: Inputs):
    return evaluation.false_positives(t.scores).select("model_name", "po_id", "probability")


@check("flt6_false_negatives", "SELECT model_name, po_id, probability FROM scores WHERE label = 1 AND prediction = 0")
def _(t: Inputs):
    return evaluation.false_negatives(t.scores).select("model_name", "po_id", "probability")


# --- nulls ----------------------------------------------------------------------------
@check("nul1_fill_vendor_gaps", f"SELECT vendor_id, composition_flag, {', '.join(FILING_QUARTERS)} FROM bronze_vendors")
def _(t: Inputs):
    return projection.fill_vendor_gaps(t.vendor_flags).select("vendor_id", "composition_flag", *FILING_QUARTERS)


_FILLED = ", ".join(f"coalesce({f}, 0) AS {f}" for f in FEATURES)


@check("nul2_fill_features", f"SELECT po_id, {_FILLED} FROM silver")
def _(t: Inputs):
    return projection.fill_features(t.silver.select("po_id", *FEATURES))


@check(
    "nul3_default_labels",
    """SELECT po_id, coalesce(is_anomalous, 0) AS is_anomalous, coalesce(anomaly_code, 'CLEAN') AS anomaly_code, severity
       FROM bronze_orders LEFT JOIN raw_labels USING (po_id)""",
)
def _(t: Inputs):
    joined = silver.attach_labels(t.orders.select("po_id"), t.raw.ground_truth)
    return projection.default_labels(joined)


# --- joins ----------------------------------------------------------------------------
@check("jn1_vendor", "SELECT po_id, trade_name, vendor_status, director_pan_1, filing_history_q1 FROM po_vendor")
def _(t: Inputs):
    return t.orders_with_vendor.select("po_id", "trade_name", "vendor_status", "director_pan_1", "filing_history_q1")


@check("jn2_invoice", "SELECT po_id, i.invoice_number, i.invoice_date, i.itc_claimed_by_buyer FROM bronze_orders LEFT JOIN invoice_one i USING (po_id)")
def _(t: Inputs):
    return t.orders_with_invoice.select("po_id", "invoice_number", "invoice_date", "itc_claimed_by_buyer")


@check("jn3_blacklist", "SELECT vendor_id, CASE WHEN gstin IN (SELECT gstin FROM raw_blacklist) THEN 1 ELSE 0 END AS blacklisted FROM raw_vendors")
def _(t: Inputs):
    flagged = keyed.member_flag(t.raw.vendors, t.raw.cbic_blacklist, ["gstin"], "blacklisted", ["vendor_id"])
    return flagged.select("vendor_id", "blacklisted")


@check("jn4_rate", "SELECT po_id, hsn_code, gst_rate FROM bronze_orders LEFT JOIN raw_rates USING (hsn_code)")
def _(t: Inputs):
    return silver.attach_rate(t.orders, t.raw.hsn_rate_schedule).select("po_id", "hsn_code", "gst_rate")


@check(
    "jn5_history",
    """SELECT po_id, h.total_po_value, h.po_count FROM bronze_orders o
       LEFT JOIN history_one h ON h.vendor_id = o.vendor_id AND h.year_month = strftime(po_date, '%Y-%m')""",
)
def _(t: Inputs):
    keyed_orders = t.orders.withColumn("year_month", scalars.year_month(F.col("po_date")))
    return silver.attach_history(keyed_orders, t.raw.historical_po_values).select("po_id", "total_po_value", "po_count")


@check("jn6_director_counts", "SELECT vendor_id, director_pan_1, director_vendor_count FROM vendor_pans LEFT JOIN pan_counts USING (director_pan_1)")
def _(t: Inputs):
    pans = t.bronze_vendors.join(t.orders.select("vendor_id").distinct(), "vendor_id", "left_semi").select("vendor_id", "director_pan_1")
    return keyed.attach_director_counts(pans, pans)


@check("jn7_labels", "SELECT po_id, l.anomaly_code, l.is_anomalous, l.severity FROM bronze_orders LEFT JOIN raw_labels l USING (po_id)")
def _(t: Inputs):
    return silver.attach_labels(t.orders.select("po_id"), t.raw.ground_truth)


@check(
    "jn8_scores",
    """SELECT o.po_id, f.prediction AS rf_prediction, f.probability AS rf_probability, b.prediction AS xgb_prediction, b.probability AS xgb_probability
       FROM bronze_orders o
       LEFT JOIN (SELECT * FROM scores WHERE model_name = 'Random Forest') f ON f.po_id = o.po_id
       LEFT JOIN (SELECT * FROM scores WHERE model_name = 'XGBoost') b ON b.po_id = o.po_id""",
)
def _(t: Inputs):
    def named(name, short):
        return t.scores_of(name).select("po_id", F.col("prediction").alias(f"{short}_prediction"), F.col("probability").alias(f"{short}_probability"))

    return gold.attach_scores(t.orders.select("po_id"), named("Random Forest", "rf"), named("XGBoost", "xgb"))


@check(
    "jn9_vendor_risk",
    "SELECT s.po_id, s.vendor_id, r.risk_tier, r.anomaly_rate, r.filing_compliance_rate FROM bronze_orders s LEFT JOIN vendor_risk r ON r.vendor_id = s.vendor_id",
)
def _(t: Inputs):
    return attach_vendor_risk(t.orders.select("po_id", "vendor_id"), t.risk)


@check("jn10_repeat_rows", "SELECT vendor_id, copy::INTEGER AS copy FROM raw_vendors, unnest(range(0, 4)) u(copy)")
def _(t: Inputs):
    return expansion.repeat_rows(t.raw.vendors.select("vendor_id"), 4)


@check("jn11_anti", "SELECT po_id, vendor_id FROM raw_orders WHERE po_id NOT IN (SELECT po_id FROM raw_invoices)")
def _(t: Inputs):
    return setops.rows_without(t.raw.purchase_orders.select("po_id", "vendor_id"), t.raw.vendor_invoices, ["po_id"])


_NUMBERED_ORDERS = "SELECT po_id, row_number() OVER (ORDER BY po_id) AS position FROM raw_orders"
_NUMBERED_INVOICES = "SELECT invoice_number, itc_claimed_by_buyer, row_number() OVER (ORDER BY invoice_number, itc_claimed_by_buyer, po_id) AS position FROM raw_invoices"


def _positional(t: Inputs, how: str):
    invoices = t.raw.vendor_invoices.withColumnRenamed("po_id", "old_po_id")
    joined = expansion.positional_join(
        t.raw.purchase_orders.select("po_id"), ["po_id"], invoices, ["invoice_number", "itc_claimed_by_buyer", "old_po_id"], how
    )
    return joined.select("position", "po_id", "invoice_number", "itc_claimed_by_buyer")


@check("jn12_positional_inner", f"SELECT * FROM ({_NUMBERED_ORDERS}) JOIN ({_NUMBERED_INVOICES}) USING (position)")
def _(t: Inputs):
    return _positional(t, "inner")


@check("jn12_positional_left", f"SELECT * FROM ({_NUMBERED_ORDERS}) LEFT JOIN ({_NUMBERED_INVOICES}) USING (position)")
def _(t: Inputs):
    return _positional(t, "left")


# --- set operations -------------------------------------------------------------------
@check("so1_append_by_name", "SELECT vendor_id, gstin FROM raw_vendors UNION ALL SELECT 'listed' AS vendor_id, gstin FROM raw_blacklist")
def _(t: Inputs):
    listed = t.raw.cbic_blacklist.select("gstin", F.lit("listed").alias("vendor_id"))
    return setops.append_by_name(t.raw.vendors.select("vendor_id", "gstin"), listed)


@check("so2_append_by_position", "SELECT po_id, invoice_number FROM raw_invoices UNION ALL SELECT po_id, anomaly_code FROM raw_labels")
def _(t: Inputs):
    return setops.append_by_position(t.raw.vendor_invoices.select("po_id", "invoice_number"), t.raw.ground_truth.select("po_id", "anomaly_code"))


@check(
    "so3_merge_first_wins",
    f"""WITH drawn AS (SELECT gstin, DATE '{AS_OF}' AS blacklist_date, 'Fake GST Registration' AS reason, 'CBIC-TEST' AS case_reference
                       FROM raw_vendors WHERE {hash_fraction('blacklist', 'gstin')} < 0.4),
             listed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gstin ORDER BY blacklist_date) AS rn FROM raw_blacklist) WHERE rn = 1)
        SELECT gstin, blacklist_date, reason, case_reference FROM listed
        UNION ALL SELECT * FROM drawn WHERE gstin NOT IN (SELECT gstin FROM listed)""",
)
def _(t: Inputs):
    drawn = t.raw.vendors.filter(scalars.hash_fraction("blacklist", F.col("gstin")) < 0.4).select(
        "gstin",
        F.to_date(F.lit(AS_OF)).alias("blacklist_date"),
        F.lit("Fake GST Registration").alias("reason"),
        F.lit("CBIC-TEST").alias("case_reference"),
    )
    return setops.merge_first_wins([t.raw.cbic_blacklist, drawn], ["gstin"])


@check("so4_replace_rows", "SELECT vendor_id, CASE WHEN status = 'Cancelled' THEN 'SHARED0001' ELSE director_pan_1 END AS director_pan_1 FROM raw_vendors")
def _(t: Inputs):
    slim = t.raw.vendors.select("vendor_id", "director_pan_1")
    rewritten = t.raw.vendors.filter("status = 'Cancelled'").select("vendor_id", F.lit("SHARED0001").alias("director_pan_1"))
    return setops.replace_rows(slim, rewritten, ["vendor_id"])


# --- all inputs as raw files, and the layer jobs ------------------------------------------
def _raw_files(t: Inputs, name: str) -> str:
    """A folder of CSV files: the input itself, and lines that cannot be read. Every row gives
    one line that ends after its first value, and one whose numbers are words (where it has any)."""
    fields = INPUT_FIELDS[name]
    raw = _raw_headers(getattr(t.raw, name).select(*[column for _, column, _ in fields]), fields)
    path = files.export_csv(raw, new_path(t.spark, f"raw-{name}"))
    # More files, each with its header, as another sender's would have. A line is one value
    # of a table with one column: nothing is quoted, trimmed or parted in it.
    header = ",".join(h for h, _, _ in fields)
    broken = [F.coalesce(F.col(f"`{fields[0][0]}`"), F.lit("none"))]
    if any(kind != "string" for _, _, kind in fields):
        broken.append(F.lit(",".join("word" for _ in fields)))
    lines = raw.select(F.explode(F.array(*broken)).alias(header))
    as_is = {"header": True, "sep": "\u0001", "quote": "", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.write.mode("append").options(**as_is).csv(path)
    return path


_INPUT_VIEWS = {
    "purchase_orders": "raw_orders",
    "vendors": "raw_vendors",
    "vendor_invoices": "raw_invoices",
    "hsn_rate_schedule": "raw_rates",
    "cbic_blacklist": "raw_blacklist",
    "historical_po_values": "raw_history",
    "ground_truth": "raw_labels",
}


def _register_input(name: str, view: str) -> None:
    columns = ", ".join(
        f"{column}::VARCHAR AS {column}" if column == "blacklist_date" else column for _, column, _ in INPUT_FIELDS[name]
    )

    @check(f"src1_input_{name}", f"SELECT {columns} FROM {view}")
    def _(t: Inputs):
        return files.read_checked(t.spark, _raw_files(t, name), INPUT_FIELDS[name], name)[0]


for _name, _view in _INPUT_VIEWS.items():
    _register_input(_name, _view)


def _quarantine_sql(name: str, view: str) -> str:
    numbers = [column for _, column, kind in INPUT_FIELDS[name] if kind != "string"]
    short = f"SELECT '{name}' AS input, 'number of values' AS reason, count(*) AS n FROM {view}"
    return f"{short} UNION ALL SELECT '{name}', 'type of {numbers[0]}', count(*) FROM {view}" if numbers else short


@check("src1_quarantine", " UNION ALL ".join(_quarantine_sql(n, v) for n, v in _INPUT_VIEWS.items()))
def _(t: Inputs):
    rejected = [files.read_checked(t.spark, _raw_files(t, n), INPUT_FIELDS[n], n)[1] for n in _INPUT_VIEWS]
    counts = [r.groupBy("input", "reason").agg(F.count("*").alias("n")) for r in rejected]
    return reduce(lambda a, b: a.union(b), counts)


@check(
    "snk2_overwrite_month",
    """SELECT po_id, CASE WHEN year = 1997 AND month = 3 THEN total_amount + 1 ELSE total_amount END AS total_amount, year, month,
              NOT (year = 1997 AND month = 3) AS untouched FROM bronze_orders""",
)
def _(t: Inputs):
    """One month is written again; the files of all other months are the same ones as before."""
    slim = t.orders.select("po_id", "total_amount", "year", "month")
    path = files.write_partitioned(slim, new_path(t.spark, "by-month"), "year", "month")
    file = F.regexp_extract("_metadata.file_path", "[^/]+$", 0)
    before = stage(t.spark.read.parquet(path).select(file.alias("file")).distinct(), "files")
    month = t.spark.read.parquet(path).filter("year = 1997 and month = 3")
    again = stage(month.withColumn("total_amount", F.col("total_amount") + 1), "month")
    files.overwrite_values(again.select(*slim.columns), path, "year", "month")
    now = t.spark.read.parquet(path).select("*", file.alias("file"))
    old = F.broadcast(before.withColumn("untouched", F.lit(True)))
    return now.join(old, "file", "left").select(*slim.columns, F.coalesce("untouched", F.lit(False)).alias("untouched"))


@check("pl3_silver_job", "SELECT * FROM silver")
def _(t: Inputs):
    """Raw files to bronze to silver, each layer published and read back."""
    return published.read_layer(t.spark, _published_silver(t), "silver", "orders")


def _published_silver(t: Inputs) -> str:
    raw, base = new_path(t.spark, "raw"), new_path(t.spark, "layers")
    for name, fields in INPUT_FIELDS.items():
        files.export_csv(_raw_headers(getattr(t.raw, name).select(*[c for _, c, _ in fields]), fields), f"{raw}/{name}")
    jobs.bronze_job(t.spark, raw, base, AS_OF)
    jobs.silver_job(t.spark, base, AS_OF)
    return base


@check("ml7_prediction_tables", """SELECT po_id, label AS actual, prediction, probability, model_name FROM scores""")
def _(t: Inputs):
    """Both models' prediction tables as catalog tables, read back."""
    found = []
    for name, short in ((FOREST_NAME, "rf"), (BOOSTED_NAME, "xgb")):
        scores = t.scores_of(name)
        saved = files.save_table(models.prediction_table(scores, short), f"{short}_predictions_{uuid.uuid4().hex}")
        back = files.read_table(t.spark, saved)
        found.append(back.withColumnsRenamed({f"{short}_prediction": "prediction", f"{short}_probability": "probability"}))
    return found[0].unionByName(found[1])


@check(
    "flt4_raised_flags",
    " UNION ALL ".join(f"SELECT po_id, '{f}' AS listing FROM silver WHERE {f} = 1" for f in RULE_FLAGS)
    + " UNION ALL SELECT po_id, 'severity Critical' FROM silver WHERE severity = 'Critical'",
)
def _(t: Inputs):
    return projection.raised_listings(t.silver)


@check(
    "ag8_distinct_sketches",
    """SELECT year, month, count(DISTINCT vendor_id) AS vendors, count(DISTINCT buyer_gstin) AS buyers, true AS vendors_close, true AS buyers_close
       FROM bronze_orders GROUP BY GROUPING SETS ((year, month), ())""",
)
def _(t: Inputs):
    """Exact distinct counts per month and over all, and whether the sketches are within 5 %."""
    columns = ["vendor_id", "buyer_gstin"]
    sketches = aggregates.distinct_sketches(t.orders, ["year", "month"], columns)
    close = aggregates.merged_estimates(sketches, ["year", "month"], columns)
    exact = t.orders.groupingSets([["year", "month"], []], "year", "month").agg(
        F.countDistinct("vendor_id").alias("vendors"), F.countDistinct("buyer_gstin").alias("buyers")
    )
    same = exact["year"].eqNullSafe(close["year"]) & exact["month"].eqNullSafe(close["month"])
    joined = exact.join(close, same)

    def near(estimate: str, count: str):
        return (F.abs(F.col(estimate) - F.col(count)) <= F.greatest(F.lit(2), F.col(count) * 0.05))

    return joined.select(
        exact["year"], exact["month"], "vendors", "buyers",
        near("vendor_id_estimate", "vendors").alias("vendors_close"), near("buyer_gstin_estimate", "buyers").alias("buyers_close"),
    )


@check("ag12_written_counts", " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {v}" for n, v in _INPUT_VIEWS.items()))
def _(t: Inputs):
    """Rows of each written input, as the layer's own table of metrics has them."""
    base = new_path(t.spark, "layers")
    published.write_layer(t.spark, base, "inputs", {name: getattr(t.raw, name) for name in _INPUT_VIEWS})
    return published.read_layer(t.spark, base, "inputs", "metrics")
