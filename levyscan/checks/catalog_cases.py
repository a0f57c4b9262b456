"""Queries for models, evaluation, analyst cases and table expansion."""

import math

from pyspark.sql import functions as F

from levyscan.checks.registry import Inputs, check
from levyscan.checks.views import hash_fraction, hash_number
from levyscan.constants import CASE_COLUMNS, FEATURES, FLAG_PROMPT, METRIC_PROMPT
from levyscan.functions import scalars
from levyscan.operators import casework, evaluation, expansion, models, ordering
from levyscan.plans import gold
from levyscan.sources.staging import Jobs, new_path, stage

# --- models ---------------------------------------------------------------------------
_FILLED = ", ".join(f"coalesce({f}, 0) AS {f}" for f in FEATURES)


@check("ml1_feature_matrix", f"SELECT po_id, is_anomalous, {_FILLED} FROM silver")
def _(t: Inputs):
    return t.features


@check("ml2_split", f"SELECT po_id, is_anomalous, {hash_fraction('split', 'po_id')} < 0.2 AS is_test FROM raw_labels")
def _(t: Inputs):
    return models.with_split(t.raw.ground_truth.select("po_id", "is_anomalous"))


@check(
    "ml2_exact_split",
    f"""SELECT po_id, is_anomalous, row_number() OVER (PARTITION BY is_anomalous ORDER BY {hash_number('split', 'po_id')}, po_id)
               <= round(count(*) OVER (PARTITION BY is_anomalous) * 0.2) AS is_test FROM raw_labels""",
)
def _(t: Inputs):
    return models.with_exact_split(t.raw.ground_truth.select("po_id", "is_anomalous"))


_fits: dict[tuple[str, str], dict] = {}
_TRAINERS = {"forest": models.train_forest, "boosted": models.train_boosted}


def _fit_once(t: Inputs, *wanted: str):
    """The test rows and the wanted models of a set of tables, each made once per application,
    the models side by side: 500 trees of full depth and 500 rounds on all training rows.
    A model that is not asked for is not fitted."""
    key = (t.spark.sparkContext.applicationId, t.base)
    made = _fits.setdefault(key, {})
    if "test" not in made:
        rows = stage(models.with_split(t.features), "features")
        made["train"] = rows.filter("not is_test")
        made["test"] = rows.filter("is_test")
    with Jobs(t.spark) as jobs:
        missing = {name: jobs.start(lambda fit=_TRAINERS[name]: fit(made["train"])) for name in wanted if name not in made}
        made.update({name: fit.result() for name, fit in missing.items()})
    return made["test"], *[made[name] for name in wanted]


_TEST_ROWS = f"silver WHERE {hash_fraction('split', 'po_id')} < 0.2"


def _scored_orders(scored, threshold: float):
    """Each order once, its label, and whether score and decision are what they must be."""
    probability = F.col("probability")
    decided = F.col("prediction") == (probability >= threshold).cast("int")
    checked = scored.select("po_id", "label", "model_name", probability.between(0, 1).alias("is_share"), decided.alias("is_decided"))
    return checked


def _scored_sql(name: str) -> str:
    return f"SELECT po_id, is_anomalous AS label, '{name}' AS model_name, true AS is_share, true AS is_decided FROM {_TEST_ROWS}"


@check("ml3_random_forest", _scored_sql("Random Forest"))
def _(t: Inputs):
    test, forest = _fit_once(t, "forest")
    over_half = math.nextafter(0.5, 1)
    return _scored_orders(models.score_forest(forest, test), over_half)


@check("ml4_boosted_trees", _scored_sql("XGBoost"))
def _(t: Inputs):
    test, boosted = _fit_once(t, "boosted")
    return _scored_orders(models.score_boosted(boosted, test), 0.35)


@check("ml3_ml4_trees", "SELECT m AS model_name, 500::BIGINT AS trees FROM (VALUES ('Random Forest'), ('XGBoost')) v(m)")
def _(t: Inputs):
    _, forest, boosted = _fit_once(t, "forest", "boosted")
    counts = [(models.FOREST_NAME, models.tree_count(forest)), (models.BOOSTED_NAME, models.tree_count(boosted))]
    return t.spark.createDataFrame(counts, "model_name string, trees long")


@check("ml5_decide", "SELECT po_id, model_name, probability, prediction FROM scores")
def _(t: Inputs):
    limits = {models.FOREST_NAME: 0.5, models.BOOSTED_NAME: models.BOOSTED_THRESHOLD}
    decided = [t.scores_of(name).withColumn("prediction", models.decide(F.col("probability"), limit)) for name, limit in limits.items()]
    return decided[0].union(decided[1]).select("po_id", "model_name", "probability", "prediction")


_TIER = "CASE WHEN probability >= 0.85 THEN 'Critical' WHEN probability >= 0.70 THEN 'High' WHEN probability >= 0.50 THEN 'Medium' ELSE 'Low' END AS risk_tier"


@check("ml6_probability_tier", f"SELECT po_id, model_name, {_TIER} FROM scores")
def _(t: Inputs):
    return t.scores.select("po_id", "model_name", models.probability_tier(F.col("probability")).alias("risk_tier"))


@check("ml7_prediction_table", f"SELECT po_id, label AS actual, prediction AS xgb_prediction, probability AS xgb_probability, model_name, {_TIER} FROM scores WHERE model_name = 'XGBoost'")
def _(t: Inputs):
    scores = t.scores_of("XGBoost")
    return models.prediction_table(scores.union(scores.filter("label = 1")), "xgb", with_tier=True)


@check("ml8_confusion", "SELECT * FROM confusion")
def _(t: Inputs):
    return evaluation.confusion_matrix(t.scores)


_SHARE = "CASE WHEN {1} > 0 THEN ({0})::DOUBLE / ({1}) ELSE 0.0 END"
_METRICS = ", ".join(
    f"{_SHARE.format(part, whole)} AS {name}"
    for part, whole, name in [
        ("tp + tn", "tp + fp + fn + tn", "accuracy"),
        ("tp", "tp + fp", "precision"),
        ("tp", "tp + fn", "recall"),
        ("2 * tp", "2 * tp + fp + fn", "f1"),
    ]
)
_AUC = """SELECT model_name, CASE WHEN max(all_pos) * max(all_neg) > 0 THEN sum(pos * (2 * (all_neg - fp) + neg))::DOUBLE
                 / (2.0::DOUBLE * max(all_pos)::DOUBLE * max(all_neg)::DOUBLE) ELSE 0.0 END AS roc_auc FROM roc_steps GROUP BY model_name"""


@check("ml9_metrics", f"SELECT model_name, {_METRICS} FROM confusion")
def _(t: Inputs):
    return evaluation.quality_metrics(t.scores)


def _side(value, tp, fp, fn):
    return (
        f"SELECT model_name, {value} AS class, {_SHARE.format(tp, f'{tp} + {fp}')} AS precision, {_SHARE.format(tp, f'{tp} + {fn}')} AS recall, "
        f"{_SHARE.format(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')} AS f1, {tp} + {fn} AS support FROM confusion"
    )


@check("ml9_class_report", f"{_side(1, 'tp', 'fp', 'fn')} UNION ALL {_side(0, 'tn', 'fn', 'fp')}")
def _(t: Inputs):
    return evaluation.class_report(t.scores)


@check("ml10_roc_auc", _AUC)
def _(t: Inputs):
    return evaluation.roc_auc(t.scores)


@check(
    "ml11_roc_points",
    """SELECT model_name AS "Model", fp::DOUBLE / all_neg AS "FPR", tp::DOUBLE / all_pos AS "TPR" FROM roc_steps
       UNION ALL SELECT DISTINCT model_name, 0.0::DOUBLE, 0.0::DOUBLE FROM roc_steps
       UNION ALL SELECT 'Random Baseline', x, x FROM (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) b(x)""",
)
def _(t: Inputs):
    return evaluation.roc_points(t.scores)


@check(
    "ml12_comparison",
    f"""SELECT model_name AS "Model", accuracy AS "Accuracy", precision AS "Precision", recall AS "Recall", f1 AS "F1", roc_auc AS "ROC_AUC"
        FROM (SELECT model_name, {_METRICS} FROM confusion) JOIN ({_AUC}) USING (model_name)""",
)
def _(t: Inputs):
    return evaluation.comparison_table(t.scores)


@check(
    "ml13_feature_importance",
    f"""SELECT m AS model_name, {len(FEATURES)}::BIGINT AS features, 1 AS least_place, {len(FEATURES)} AS most_place, 1.0::DOUBLE AS total, true AS in_order
        FROM (VALUES ('Random Forest'), ('XGBoost')) v(m)""",
)
def _(t: Inputs):
    """Each model's features with their places: all of them, in order of weights that sum to 1."""
    _, forest, boosted = _fit_once(t, "forest", "boosted")
    both = models.feature_importance(forest, models.FOREST_NAME).union(models.feature_importance(boosted, models.BOOSTED_NAME))
    ranked = ordering.rank_within(both, "model_name", [F.desc("importance_score"), F.col("feature_name")], "place")
    pairs = F.array_sort(F.collect_list(F.struct("place", "importance_score")))
    weights = F.transform(pairs, lambda p: p["importance_score"])
    return ranked.groupBy("model_name").agg(
        F.countDistinct("feature_name").alias("features"),
        F.min("place").cast("int").alias("least_place"),
        F.max("place").cast("int").alias("most_place"),
        F.round(F.sum("importance_score"), 6).alias("total"),
        (weights == F.reverse(F.array_sort(weights))).alias("in_order"),
    )


@check("ml14_save_and_load", f"SELECT po_id, m AS model_name, true AS is_same FROM (VALUES ('Random Forest'), ('XGBoost')) v(m), {_TEST_ROWS}")
def _(t: Inputs):
    """Score and decision of every order before and after the models went through storage."""
    test, forest, boosted = _fit_once(t, "forest", "boosted")

    def through_storage(model, score):
        again = models.load_model(models.save_model(model, new_path(t.spark, "model")))
        before = score(model, test).select("po_id", "model_name", F.struct("prediction", "probability").alias("before"))
        after = score(again, test).select("po_id", F.struct("prediction", "probability").alias("after"))
        return before.join(after, "po_id").select("po_id", "model_name", F.col("before").eqNullSafe(F.col("after")).alias("is_same"))

    with Jobs(t.spark) as jobs:
        both = [jobs.start(lambda m=m, score=score: through_storage(m, score)) for m, score in ((forest, models.score_forest), (boosted, models.score_boosted))]
        return both[0].result().union(both[1].result())


# --- analyst cases --------------------------------------------------------------------
@check("ai1_case_table", f"SELECT {', '.join(CASE_COLUMNS)} FROM cases")
def _(t: Inputs):
    return casework.case_table(t.flags, t.risk)


def _loose_cases(t: Inputs):
    """Cases with gaps in each guarded field."""
    k = F.col("quantity")
    return t.raw.purchase_orders.select(
        F.when(k == 3, "").when(k == 4, F.lit(None)).otherwise(F.col("po_id")).alias("po_id"),
        F.when(k == 5, "").otherwise(F.col("vendor_id")).alias("vendor_id"),
        F.when(k != 6, k * 2.0).alias("rule_score"),
    )


_LOOSE = """(SELECT CASE quantity WHEN 3 THEN '' WHEN 4 THEN NULL ELSE po_id END AS po_id,
                    CASE WHEN quantity = 5 THEN '' ELSE vendor_id END AS vendor_id,
                    CASE WHEN quantity <> 6 THEN quantity * 2.0::DOUBLE END AS rule_score FROM raw_orders)"""
_VALID = "coalesce(po_id, '') <> '' AND coalesce(vendor_id, '') <> '' AND rule_score IS NOT NULL"


@check("ai2_guardrail", f"SELECT *, {_VALID} AS is_valid FROM {_LOOSE}")
def _(t: Inputs):
    return casework.with_guardrail(_loose_cases(t))


@check("ai2_guardrail_rejected", f"SELECT * FROM {_LOOSE} WHERE NOT ({_VALID})")
def _(t: Inputs):
    return casework.split_by_guardrail(_loose_cases(t))[1]


def _prompt_sql(template: str) -> str:
    from string import Formatter

    parts = []
    for text, field, _, _ in Formatter().parse(template):
        if text:
            parts.append("'" + text.replace("'", "''") + "'")
        if field:
            parts.append(f"coalesce({field}::VARCHAR, 'None')")
    return " || ".join(parts)


@check("ai3_flag_prompt", f"SELECT po_id, {_prompt_sql(FLAG_PROMPT)} AS prompt FROM cases WHERE rule_score < 70")
def _(t: Inputs):
    cases = casework.attach_vendor_risk(t.flags.filter("rule_score < 70"), t.risk)
    return casework.build_prompt(cases, FLAG_PROMPT).select("po_id", "prompt")


@check("ai3_metric_prompt", f"SELECT po_id, {_prompt_sql(METRIC_PROMPT)} AS prompt FROM cases WHERE rule_score < 70")
def _(t: Inputs):
    cases = casework.attach_vendor_risk(t.flags.filter("rule_score < 70"), t.risk)
    return casework.build_prompt(cases, METRIC_PROMPT).select("po_id", "prompt")


def _responses(t: Inputs):
    """Answers as a model gives them: with text around, over many lines, broken, or none."""
    k = F.col("quantity")
    body = F.concat(
        F.lit('{\n"risk_level":"'),
        F.when(k % 3 == 0, "High").otherwise("Low"),
        F.lit('",\n"anomaly_types_detected":["GST Risk", "'),
        "hsn_code",
        F.lit('"],\n"reasoning":"checked '),
        "po_id",
        F.lit('","recommended_action":"Manual audit required.","confidence_score":'),
        F.when(k % 2 == 0, F.concat(F.lit('"0.'), k.cast("string"), F.lit('"'))).otherwise(k.cast("string")),
        F.lit("}"),
    )
    text = (
        F.when(k % 10 == 1, "I cannot judge this record.")
        .when(k % 10 == 2, F.concat(F.lit("{ broken "), "po_id", F.lit(" }")))
        .when(k % 10 == 3, F.concat(F.lit("Here is the result:\n"), body, F.lit("\nDone.")))
        .when(k % 10 == 4, F.concat(body, F.lit(" and "), body))
        .when(k % 10 == 5, F.concat(F.lit("{'risk_level':'High','reasoning':'"), "po_id", F.lit("'}")))
        .when(k % 10 == 6, F.concat(body, F.lit(" trailing }")))
        .when(k % 10 == 7, F.concat(body, F.lit(","), body))
        .otherwise(body)
    )
    return t.orders.select("po_id", text.alias("response"))


_RESPONSES = r"""(SELECT po_id, CASE WHEN quantity % 10 = 1 THEN 'I cannot judge this record.'
        WHEN quantity % 10 = 2 THEN '{ broken ' || po_id || ' }'
        WHEN quantity % 10 = 3 THEN 'Here is the result:' || chr(10) || body || chr(10) || 'Done.'
        WHEN quantity % 10 = 4 THEN body || ' and ' || body
        WHEN quantity % 10 = 5 THEN '{''risk_level'':''High'',''reasoning'':''' || po_id || '''}'
        WHEN quantity % 10 = 6 THEN body || ' trailing }'
        WHEN quantity % 10 = 7 THEN body || ',' || body ELSE body END AS response
    FROM (SELECT po_id, quantity, '{' || chr(10) || '"risk_level":"' || CASE WHEN quantity % 3 = 0 THEN 'High' ELSE 'Low' END
        || '",' || chr(10) || '"anomaly_types_detected":["GST Risk", "' || hsn_code || '"],' || chr(10) || '"reasoning":"checked ' || po_id
        || '","recommended_action":"Manual audit required.","confidence_score":'
        || CASE WHEN quantity % 2 = 0 THEN '"0.' || quantity || '"' ELSE quantity::VARCHAR END || '}' AS body FROM bronze_orders))"""
_SPANS = rf"(SELECT po_id, response, regexp_extract(response, '(?s)\{{.*\}}') AS span FROM {_RESPONSES})"
_PARSED = f"""(SELECT po_id, j->>'risk_level' AS risk_level,
        '[' || list_aggregate(list_transform((j->'anomaly_types_detected')::VARCHAR[], lambda x: '''' || x || ''''), 'string_agg', ', ') || ']' AS anomaly_types_detected,
        j->>'reasoning' AS reasoning, j->>'recommended_action' AS recommended_action, j->>'confidence_score' AS confidence_score
    FROM (SELECT po_id, CASE WHEN json_valid(span) THEN span::JSON END AS j FROM {_SPANS} WHERE span <> '' AND json_valid(span)))"""


@check("ai4_parse_responses", f"SELECT * FROM {_PARSED}")
def _(t: Inputs):
    return casework.parse_responses(_responses(t))


@check("ai4_rejected_responses", f"SELECT po_id, response FROM {_SPANS} WHERE span = '' OR NOT json_valid(span)")
def _(t: Inputs):
    return casework.rejected_responses(_responses(t))


@check(
    "ai5_risk_reasons",
    """SELECT po_id, concat_ws('; ', CASE WHEN rule_score < 70 THEN 'Rule score below 70' END, CASE WHEN filing_compliance_rate < 0.5 THEN 'Filing compliance below 0.5' END,
              CASE WHEN anomaly_rate > 0.5 THEN 'Anomaly rate above 0.5' END, CASE WHEN risk_tier = 'Critical' THEN 'Critical risk tier' END) AS reasons,
              (CASE WHEN rule_score < 70 THEN 1 ELSE 0 END + CASE WHEN filing_compliance_rate < 0.5 THEN 1 ELSE 0 END
               + CASE WHEN anomaly_rate > 0.5 THEN 1 ELSE 0 END + CASE WHEN risk_tier = 'Critical' THEN 1 ELSE 0 END)::INTEGER AS n_reasons
       FROM cases""",
)
def _(t: Inputs):
    cases = casework.risk_reasons(casework.attach_vendor_risk(t.flags, t.risk))
    return cases.select("po_id", F.array_join("reasons", "; ").alias("reasons"), "n_reasons")


@check(
    "ai6_confidence",
    f"SELECT po_id, CASE WHEN c > 1 THEN c / 100 ELSE c END AS confidence FROM (SELECT po_id, TRY_CAST(confidence_score AS DOUBLE) AS c FROM {_PARSED})",
)
def _(t: Inputs):
    parsed = casework.parse_responses(_responses(t))
    return parsed.select("po_id", casework.normalise_confidence(F.col("confidence_score")).alias("confidence"))


_DRILL = "PO0000015"


@check(
    "pl6_order_drilldown",
    f"""SELECT c.po_id, c.vendor_id, rule_fail_count, rule_score, severity_dashboard, rf_probability, xgb_probability, risk_tier, anomaly_rate,
               risk_level, anomaly_types_detected, reasoning, recommended_action, confidence_score
        FROM cases c LEFT JOIN {_PARSED} p ON p.po_id = c.po_id WHERE c.po_id = '{_DRILL}'""",
)
def _(t: Inputs):
    return gold.order_drilldown(t.flags, t.risk, _responses(t), _DRILL).select(
        "po_id", "vendor_id", "rule_fail_count", "rule_score", "severity_dashboard", "rf_probability", "xgb_probability",
        "risk_tier", "anomaly_rate", *casework.RESPONSE_FIELDS,
    )


# --- expansion ------------------------------------------------------------------------
@check(
    "xp1_expand_rows",
    """WITH v AS (SELECT trade_name, row_number() OVER (ORDER BY vendor_id) AS rn, count(*) OVER () AS n FROM raw_vendors)
       SELECT trade_name, printf('V%05d', copy * n + rn) AS vendor_id FROM v, unnest(range(0, 3)) u(copy) WHERE copy * n + rn <= n * 5 // 2""",
)
def _(t: Inputs):
    vendors = t.raw.vendors.select("vendor_id", "trade_name")
    return expansion.expand_rows(vendors, vendors.count() * 5 // 2, ["vendor_id"], "vendor_id", "V", 5)


@check(
    "xp2_assign_key",
    f"""SELECT o.po_id, v.vendor_id FROM (SELECT po_id, {hash_number('assign', 'po_id')} % (SELECT count(*) FROM raw_vendors) + 1 AS rn FROM raw_orders) o
        JOIN (SELECT vendor_id, row_number() OVER (ORDER BY vendor_id) AS rn FROM raw_vendors) v ON v.rn = o.rn""",
)
def _(t: Inputs):
    orders = t.raw.purchase_orders.select("po_id", "vendor_id")
    return expansion.assign_key(orders, t.raw.vendors, "vendor_id", "po_id", "assign")


@check(
    "xp3_perturb",
    f"""SELECT po_id, CASE WHEN {hash_fraction('name', 'po_id')} < 0.012 THEN 'XYZ TRADING COMPANY' ELSE invoice_billing_name END AS invoice_billing_name,
               CASE WHEN {hash_fraction('ewb', 'po_id')} < 0.1 THEN NULL ELSE ewb_number END AS ewb_number,
               CASE WHEN {hash_fraction('qty', 'po_id')} < 0.05 THEN quantity * 10 ELSE quantity END AS quantity,
               CASE WHEN {hash_fraction('rate', 'po_id')} < 0.07 THEN cgst_rate + 5 ELSE cgst_rate END AS cgst_rate FROM raw_orders""",
)
def _(t: Inputs):
    orders = t.raw.purchase_orders.select("po_id", "invoice_billing_name", "ewb_number", "quantity", "cgst_rate")
    changes = [
        ("invoice_billing_name", 0.012, F.lit("XYZ TRADING COMPANY"), "name"),
        ("ewb_number", 0.1, F.lit(None).cast("string"), "ewb"),
        ("quantity", 0.05, F.col("quantity") * 10, "qty"),
        ("cgst_rate", 0.07, F.col("cgst_rate") + 5, "rate"),
    ]
    for column, rate, change, salt in changes:
        orders = expansion.perturb(orders, column, rate, change, salt, "po_id")
    return orders


@check(
    "xp6_duplicate_rows",
    f"SELECT po_id, anomaly_code FROM raw_labels UNION ALL (SELECT po_id, anomaly_code FROM raw_labels ORDER BY {hash_number('twice', 'po_id')}, po_id LIMIT 100)",
)
def _(t: Inputs):
    return expansion.duplicate_rows(t.raw.ground_truth.select("po_id", "anomaly_code"), 100, "twice", "po_id")


