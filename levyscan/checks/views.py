"""The same inputs and layers once more, as plain SQL for an independent engine.

`with_views(sql)` puts in front of a statement just those views that it names, directly or
through other views.
"""

import re

from levyscan.constants import FALSE_MARKS, GSTIN_PATTERN, RULE_FLAGS, STATE_NAMES, TRUE_MARKS

AS_OF = "2024-06-30"

_STATES = ", ".join(f"('{c}', '{n}')" for c, n in STATE_NAMES.items())
_TRUE = ", ".join(f"'{m}'" for m in TRUE_MARKS)
_FALSE = ", ".join(f"'{m}'" for m in FALSE_MARKS)


def _gstin(nation: str, key: str) -> str:
    return (
        f"lpad(({nation} + 1)::VARCHAR, 2, '0') || 'ABCDE' || lpad(({key} % 10000)::VARCHAR, 4, '0') || 'F1'"
        f" || CASE WHEN {key} % 17 = 0 THEN 'X' ELSE 'Z' END || ({key} % 10)::VARCHAR"
    )


def _two_style(key: str, day: str) -> str:
    return f"CASE WHEN {key} % 2 = 0 THEN strftime({day}, '%d/%m/%Y') ELSE strftime({day}, '%Y-%m-%d') END"


def date_of(text: str) -> str:
    return f"try_strptime({text}, ['%d/%m/%Y', '%Y-%m-%d'])::DATE"


def mark_flag(text: str) -> str:
    return f"CASE WHEN {text} IN ({_TRUE}) THEN 1 WHEN {text} IN ({_FALSE}) THEN 0 ELSE 0 END"


def hash_number(salt: str, *keys: str) -> str:
    text = " || '|' || ".join([f"'{salt}'", *[f"{k}::VARCHAR" for k in keys]])
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def hash_fraction(salt: str, *keys: str) -> str:
    return f"({hash_number(salt, *keys)} / 1152921504606846976.0::DOUBLE)"


def exact_sum(value: str, scale: int = 6) -> str:
    return f"sum(({value})::DECIMAL(28,{scale}))::DOUBLE"


def exact_avg(value: str, scale: int = 12) -> str:
    return f"(CASE WHEN count({value}) = 0 THEN NULL ELSE {exact_sum(value, scale)} / count({value}) END)"


def round2(value: str) -> str:
    return f"round((({value})::DOUBLE)::VARCHAR::DECIMAL(38,18), 2)::DOUBLE"


def columns_of(prefix: str, names: list[str]) -> str:
    return ", ".join(f"{prefix}.{n}" for n in names)


def _quarter(q: int) -> str:
    gap = "WHEN s_suppkey % 31 = 0 THEN NULL " if q == 0 else ""
    return f"CASE {gap}WHEN (s_suppkey + {3 * q}) % 5 < 3 THEN '✓' ELSE '✗' END AS filing_history_q{q + 1}"


_QUARTERS = [f"filing_history_q{q}" for q in range(1, 7)]
_FILED = " + ".join(_QUARTERS)

VIEWS = {
    "state_names": f"SELECT * FROM (VALUES {_STATES}) t(code, state_name)",
    "raw_vendors": f"""
        SELECT printf('V%05d', s_suppkey + 1) AS vendor_id,
               {_gstin('s_nationkey', 's_suppkey')} AS gstin,
               s_name AS trade_name,
               'Legal ' || s_name AS legal_name,
               state_name AS billing_state,
               {_two_style('s_suppkey', "(DATE '2012-01-01' + ((s_suppkey * 37) % 4000)::INTEGER)")} AS registration_date,
               CASE WHEN s_suppkey % 20 = 7 THEN 'Cancelled' ELSE 'Active' END AS status,
               CASE WHEN s_suppkey % 12 = 0 THEN 'Yes' ELSE 'No' END AS composition_flag,
               {", ".join(_quarter(q) for q in range(6))},
               CASE WHEN s_suppkey % 23 <> 0 THEN 'PANAA' || lpad((s_suppkey % 90)::VARCHAR, 4, '0') || 'A' END AS director_pan_1,
               CASE WHEN s_suppkey % 3 <> 0 THEN 'PANBB' || lpad((s_suppkey % 70)::VARCHAR, 4, '0') || 'B' END AS director_pan_2
        FROM supplier LEFT JOIN state_names ON code = lpad((s_nationkey + 1)::VARCHAR, 2, '0')""",
    "raw_rates": """
        SELECT DISTINCT p_type AS hsn_code, p_type || ' goods' AS description,
               CASE p_type WHEN 'ECONOMY' THEN 5.0 WHEN 'STANDARD' THEN 12.0 WHEN 'PROMO' THEN 18.0
                           WHEN 'SMALL' THEN 18.0 ELSE 28.0 END::DOUBLE AS gst_rate,
               'No' AS cess_applicable, '2017-07-01' AS effective_from
        FROM part""",
    "order_base": """
        SELECT o_orderkey AS k, o_totalprice AS price, o_orderdate::DATE AS day, o_custkey AS c,
               c_nationkey AS nation, s, s_name, p_type, p_name
        FROM orders
        LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS s, min(l_partkey) AS p FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey
        LEFT JOIN customer ON c_custkey = o_custkey
        LEFT JOIN part ON p_partkey = p
        LEFT JOIN supplier ON s_suppkey = s""",
    "rated_base": """
        SELECT *, half + CASE WHEN k % 97 = 0 THEN 5.0 ELSE 0.0 END::DOUBLE AS cgst_rate, half AS sgst_rate,
               CASE WHEN k % 113 = 0 THEN 18.0 ELSE 0.0 END::DOUBLE AS igst_rate
        FROM (SELECT *, CASE p_type WHEN 'ECONOMY' THEN 2.5 WHEN 'STANDARD' THEN 6.0 WHEN 'PROMO' THEN 9.0 WHEN 'SMALL' THEN 9.0
                        ELSE CASE WHEN p_type IS NOT NULL THEN 14.0 END END::DOUBLE AS half FROM order_base)""",
    "raw_orders": f"""
        SELECT printf('PO%07d', k + 1) AS po_id,
               strftime(day, '%d/%m/%Y') AS po_date,
               CASE WHEN s IS NOT NULL THEN printf('V%05d', s + 1) END AS vendor_id,
               {_gstin('nation', 'c')} AS buyer_gstin,
               CASE WHEN k % 19 = 0 THEN 'Karnataka' ELSE state_name END AS buyer_state,
               p_type AS hsn_code, p_name AS product_desc,
               (k % 50 + 1)::INTEGER AS quantity, 'NOS' AS unit, price AS base_amount,
               cgst_rate, sgst_rate, igst_rate,
               price * cgst_rate / 100.0::DOUBLE AS cgst_amt,
               price * sgst_rate / 100.0::DOUBLE AS sgst_amt,
               price * igst_rate / 100.0::DOUBLE AS igst_amt,
               0.0::DOUBLE AS cess_amt,
               price * 1.18::DOUBLE AS total_amount,
               CASE WHEN k % 11 <> 0 THEN 'EWB' || k::VARCHAR END AS ewb_number,
               {_two_style('k', '(day + 1)')} AS ewb_generated_date,
               state_name AS place_of_supply, state_name AS delivery_state,
               CASE WHEN k % 29 = 0 THEN NULL WHEN k % 13 = 0 THEN 'XYZ TRADING COMPANY'
                    WHEN k % 17 = 5 THEN upper(s_name) WHEN k % 19 = 7 THEN s_name || ' Pvt Ltd' ELSE s_name END AS invoice_billing_name,
               s_name AS po_vendor_name
        FROM rated_base LEFT JOIN state_names ON code = lpad((nation + 1)::VARCHAR, 2, '0')""",
    "raw_invoices": f"""
        SELECT printf('PO%07d', o_orderkey + 1) AS po_id,
               {_two_style('o_orderkey', '(o_orderdate::DATE + ((7 * o_orderkey) % 45)::INTEGER)')} AS invoice_date,
               CASE WHEN o_orderkey % 40 = 1 THEN 'INVDUP' ELSE printf('INV%08d', o_orderkey + 1) END AS invoice_number,
               o_totalprice * 0.18::DOUBLE AS gstr2b_itc_available,
               o_totalprice * CASE WHEN o_orderkey % 200 = 0 THEN 0.27 ELSE 0.18 END::DOUBLE * (copy + 1) AS itc_claimed_by_buyer
        FROM orders, unnest(range(0, CASE WHEN o_orderkey % 150 = 7 THEN 2 ELSE 1 END)) u(copy)
        WHERE o_orderkey % 101 <> 0""",
    "raw_blacklist": f"""
        SELECT {_gstin('s_nationkey', 's_suppkey')} AS gstin,
               DATE '2023-04-01' + copy::INTEGER AS blacklist_date,
               'Fake GST Registration' AS reason, 'CBIC-' || s_suppkey::VARCHAR AS case_reference
        FROM supplier, unnest(range(0, CASE WHEN (s_suppkey + 1) % 40 = 4 THEN 2 ELSE 1 END)) u(copy)
        WHERE (s_suppkey + 1) % 20 = 4""",
    "raw_labels": """
        SELECT po_id, anomaly_code, CASE WHEN anomaly_code = 'CLEAN' THEN 0 ELSE 1 END AS is_anomalous,
               CASE WHEN anomaly_code = 'CLEAN' THEN 'Low' ELSE 'High' END AS severity
        FROM (SELECT printf('PO%07d', o_orderkey + 1) AS po_id,
                     CASE o_orderkey % 50 WHEN 0 THEN 'GST-001' WHEN 1 THEN 'TAX-001' WHEN 2 THEN 'FRD-006' ELSE 'CLEAN' END AS anomaly_code
              FROM orders WHERE o_orderkey % 37 <> 0)""",
    "raw_history": f"""
        SELECT printf('V%05d', s + 1) AS vendor_id, strftime(day, '%Y-%m') AS year_month,
               {exact_sum('price * 1.18::DOUBLE')} / count(*) AS total_po_value, count(*) AS po_count
        FROM order_base WHERE s % 9 <> 0 GROUP BY s, strftime(day, '%Y-%m')""",
    "bronze_orders": f"""
        SELECT * REPLACE ({date_of('po_date')} AS po_date), year({date_of('po_date')})::INTEGER AS year,
               month({date_of('po_date')})::INTEGER AS month, TIMESTAMP '{AS_OF} 00:00:00' AS ingestion_timestamp
        FROM raw_orders WHERE po_id IS NOT NULL AND vendor_id IS NOT NULL""",
    "vendor_flags": f"""
        SELECT * REPLACE ({mark_flag('composition_flag')} AS composition_flag,
               {", ".join(f"CASE WHEN {q} IS NOT NULL THEN {mark_flag(q)} END AS {q}" for q in _QUARTERS)})
        FROM raw_vendors""",
    "bronze_vendors": f"""
        SELECT * REPLACE ({", ".join(f"coalesce({c}, 0) AS {c}" for c in ["composition_flag", *_QUARTERS])}),
               TIMESTAMP '{AS_OF} 00:00:00' AS ingestion_timestamp
        FROM vendor_flags""",
    "invoice_one": f"""
        SELECT po_id, {date_of('invoice_date')} AS invoice_date, invoice_number, gstr2b_itc_available, itc_claimed_by_buyer
        FROM (SELECT *, row_number() OVER (PARTITION BY po_id ORDER BY {date_of('invoice_date')}, invoice_number, gstr2b_itc_available, itc_claimed_by_buyer) AS rn
              FROM raw_invoices) WHERE rn = 1""",
    "history_one": f"""
        SELECT vendor_id, year_month, {exact_avg('total_po_value', 6)} AS total_po_value, avg(po_count) AS po_count
        FROM raw_history GROUP BY vendor_id, year_month""",
    "vendor_pans": """
        SELECT DISTINCT vendor_id, director_pan_1 FROM bronze_vendors WHERE vendor_id IN (SELECT vendor_id FROM bronze_orders)""",
    "pan_counts": """
        SELECT director_pan_1, count(DISTINCT vendor_id) AS director_vendor_count FROM vendor_pans
        WHERE director_pan_1 IS NOT NULL GROUP BY director_pan_1""",
    "name_pairs": """
        SELECT DISTINCT lower(invoice_billing_name) AS a, lower(trade_name) AS b
        FROM bronze_orders JOIN bronze_vendors USING (vendor_id)
        WHERE invoice_billing_name IS NOT NULL AND trade_name IS NOT NULL""",
    "lcs_rows": """
        SELECT a, b, 0::BIGINT AS i, list_transform(range(0, length(b) + 1), lambda x: 0::BIGINT) AS cells FROM name_pairs
        UNION ALL
        SELECT a, b, i + 1, list_prepend(0::BIGINT, list_transform(range(1, length(b) + 1), lambda j: list_max(best[1:j])))
        FROM (SELECT a, b, i, list_transform(range(1, length(b) + 1), lambda j: greatest(cells[j + 1],
                     CASE WHEN substr(b, j, 1) = substr(a, i + 1, 1) THEN cells[j] + 1 ELSE 0::BIGINT END)) AS best
              FROM lcs_rows WHERE i < length(a))""",
    "pair_scores": """
        SELECT a, b, 2 * cells[length(b) + 1]::DOUBLE / (length(a) + length(b)) AS score FROM lcs_rows WHERE i = length(a)""",
    "po_vendor": f"""
        SELECT o.*, v.gstin, v.trade_name, v.legal_name, v.billing_state, {date_of('v.registration_date')} AS registration_date,
               v.status AS vendor_status, v.composition_flag, {columns_of('v', _QUARTERS)}, v.director_pan_1, v.director_pan_2
        FROM bronze_orders o LEFT JOIN bronze_vendors v ON o.vendor_id = v.vendor_id""",
    "joined": f"""
        SELECT p.* REPLACE ({date_of('p.ewb_generated_date')} AS ewb_generated_date),
               i.invoice_date, i.invoice_number, i.gstr2b_itc_available, i.itc_claimed_by_buyer,
               l.severity, coalesce(l.is_anomalous, 0) AS is_anomalous, coalesce(l.anomaly_code, 'CLEAN') AS anomaly_code,
               r.gst_rate, h.total_po_value, h.po_count, strftime(p.po_date, '%Y-%m') AS year_month,
               CASE WHEN p.gstin IN (SELECT gstin FROM raw_blacklist) THEN 1 ELSE 0 END AS blacklisted,
               d.director_vendor_count, n.state_name AS gst_state_name, substr(p.buyer_gstin, 1, 2) AS gst_state_code,
               {round2('h.total_po_value / h.po_count')} AS avg_po_value,
               CASE WHEN p.invoice_billing_name IS NULL OR p.trade_name IS NULL THEN 0.0 ELSE s.score END::DOUBLE AS name_sim_score
        FROM po_vendor p
        LEFT JOIN invoice_one i ON i.po_id = p.po_id
        LEFT JOIN raw_labels l ON l.po_id = p.po_id
        LEFT JOIN raw_rates r ON r.hsn_code = p.hsn_code
        LEFT JOIN history_one h ON h.vendor_id = p.vendor_id AND h.year_month = strftime(p.po_date, '%Y-%m')
        LEFT JOIN pan_counts d ON d.director_pan_1 = p.director_pan_1
        LEFT JOIN state_names n ON n.code = substr(p.buyer_gstin, 1, 2)
        LEFT JOIN pair_scores s ON s.a = lower(p.invoice_billing_name) AND s.b = lower(p.trade_name)""",
    "flagged": f"""
        SELECT *, regexp_matches(buyer_gstin, '{GSTIN_PATTERN}') AS is_gstin_valid,
               CASE WHEN lower(buyer_state) <> lower(gst_state_name) THEN 1 ELSE 0 END AS state_mismatch,
               cgst_rate + sgst_rate + igst_rate AS actual_gst_rate,
               CASE WHEN cgst_rate + sgst_rate + igst_rate <> gst_rate THEN 1 ELSE 0 END AS rate_mismatch,
               abs(cgst_rate + sgst_rate + igst_rate - gst_rate) AS hsn_rate_delta,
               CASE WHEN avg_po_value > 0 THEN {round2('total_amount / avg_po_value')} ELSE 0.0 END::DOUBLE AS spike_ratio,
               CASE WHEN avg_po_value > 0 THEN total_amount / avg_po_value ELSE 0.0::DOUBLE END AS invoice_to_avg_ratio,
               CASE WHEN name_sim_score < 0.85 THEN 1 ELSE 0 END AS name_mismatch,
               CASE WHEN director_vendor_count > 1 THEN 1 ELSE 0 END AS director_overlap_flag,
               CASE WHEN date_diff('day', po_date, invoice_date) > 30 THEN 1 ELSE 0 END AS late_invoice,
               ({_FILED}) / 6.0::DOUBLE AS filing_compliance_rate,
               CASE WHEN {_FILED} < 4 THEN 1 ELSE 0 END AS vendor_non_filer,
               CASE WHEN total_amount > 50000 AND ewb_number IS NULL THEN 1 ELSE 0 END AS missing_ewb,
               CASE WHEN total_amount > 500000 THEN 1 ELSE 0 END AS high_value_invoice_flag,
               CASE WHEN month(invoice_date) = 3 THEN 1 ELSE 0 END AS is_march_invoice,
               date_diff('day', registration_date, DATE '{AS_OF}')::INTEGER AS vendor_age_days,
               count(*) OVER (PARTITION BY gstin, invoice_number, year, month) AS invoice_dup_count,
               count(*) OVER (PARTITION BY vendor_id, invoice_date) AS invoice_count_same_vendor_same_day,
               count(po_id) OVER (PARTITION BY vendor_id) AS vendor_po_frequency
        FROM joined""",
    "counted": """
        SELECT *, CASE WHEN spike_ratio > 3 THEN 1 ELSE 0 END AS value_spike,
               CASE WHEN invoice_dup_count > 1 THEN 1 ELSE 0 END AS duplicate_invoice
        FROM flagged""",
    "silver": f"""
        SELECT *, ({" + ".join(RULE_FLAGS)})::INTEGER AS rule_fail_count,
               round((1 - ({" + ".join(RULE_FLAGS)}) / 10.0::DOUBLE) * 100, 2) AS rule_score
        FROM counted""",
    "vendor_risk": f"""
        SELECT *, CASE WHEN anomaly_rate >= 0.20 THEN 'Critical' WHEN anomaly_rate >= 0.10 THEN 'High'
                       WHEN anomaly_rate >= 0.05 THEN 'Medium' ELSE 'Low' END AS risk_tier
        FROM (SELECT vendor_id, trade_name, gstin, {exact_sum('total_amount')} AS total_po_value, count(*) AS total_po_count,
                     sum(is_anomalous)::BIGINT AS anomaly_count, sum(is_anomalous)::DOUBLE / count(*) AS anomaly_rate,
                     {exact_avg('name_sim_score')} AS avg_name_sim_score,
                     {exact_avg('filing_compliance_rate')} AS filing_compliance_rate
              FROM silver GROUP BY vendor_id, trade_name, gstin)""",
    "scores": f"""
        SELECT po_id, label, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction, probability, 'Random Forest' AS model_name
        FROM (SELECT po_id, is_anomalous AS label, ({hash_number('forest', 'po_id')} % 1000) / 1000.0::DOUBLE AS probability FROM raw_labels)
        UNION ALL
        SELECT po_id, label, CASE WHEN probability >= 0.35 THEN 1 ELSE 0 END AS prediction, probability, 'XGBoost' AS model_name
        FROM (SELECT po_id, is_anomalous AS label, ({hash_number('boosted', 'po_id')} % 1000 + 300 * is_anomalous) / 1300.0::DOUBLE AS probability FROM raw_labels)""",
    "gold_flags": """
        SELECT s.po_id, s.vendor_id, po_date, invoice_number, invoice_date, is_gstin_valid, blacklisted, rate_mismatch, value_spike,
               name_mismatch, duplicate_invoice, director_overlap_flag, vendor_non_filer, missing_ewb, state_mismatch, late_invoice,
               billing_state, rule_fail_count, rule_score, is_anomalous, severity, anomaly_code,
               CASE WHEN rule_fail_count >= 6 THEN 'Critical' WHEN rule_fail_count >= 4 THEN 'High'
                    WHEN rule_fail_count >= 2 THEN 'Medium' ELSE 'Low' END AS severity_dashboard,
               f.prediction AS rf_prediction, f.probability AS rf_probability,
               b.prediction AS xgb_prediction, b.probability AS xgb_probability
        FROM silver s
        LEFT JOIN (SELECT * FROM scores WHERE model_name = 'Random Forest') f ON f.po_id = s.po_id
        LEFT JOIN (SELECT * FROM scores WHERE model_name = 'XGBoost') b ON b.po_id = s.po_id""",
    "cases": """
        SELECT g.*, r.risk_tier, r.anomaly_rate, r.filing_compliance_rate
        FROM gold_flags g LEFT JOIN vendor_risk r ON r.vendor_id = g.vendor_id""",
    "roc_steps": """
        SELECT model_name, probability, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
               sum(pos) OVER (PARTITION BY model_name) AS all_pos, sum(neg) OVER (PARTITION BY model_name) AS all_neg
        FROM (SELECT model_name, probability, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
              FROM scores GROUP BY 1, 2)
        WINDOW w AS (PARTITION BY model_name ORDER BY probability DESC)""",
    "confusion": """
        SELECT model_name, count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
               count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn
        FROM scores GROUP BY model_name""",
}


def with_views(sql: str) -> str:
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_]+", text)):
            if word in VIEWS and word not in needed:
                needed.add(word)
                visit(VIEWS[word])

    visit(sql)
    if not needed:
        return sql
    parts = ", ".join(f"{name} AS ({body})" for name, body in VIEWS.items() if name in needed)
    own = sql.strip()
    if own.startswith("WITH "):
        return f"WITH RECURSIVE {parts}, {own.removeprefix('WITH ')}"
    return f"WITH RECURSIVE {parts} {own}"
