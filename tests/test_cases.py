from pyspark.sql import functions as F

from levyscan.constants import METRIC_PROMPT
from levyscan.operators import casework, expansion, projection, setops


def parse(spark, *texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "po_id string, response string")
    return df, {r.po_id: r for r in casework.parse_responses(df).collect()}


def test_parse_takes_first_to_last_brace(spark):
    good = '{"risk_level":"High","anomaly_types_detected":["GST Risk","it\'s"],"reasoning":"a } b",\n"confidence_score":0.8}'
    df, got = parse(spark, f"Sure:\n{good}\nbye", "none", "{ bad }", '{"risk_level":"Low","confidence_score":"0.80"}', None, "{}")
    assert set(got) == {"0", "3", "5"}
    assert got["0"].anomaly_types_detected == "['GST Risk', \"it's\"]"
    assert got["0"].reasoning == "a } b"
    assert got["0"].confidence_score == "0.8"
    assert got["3"].confidence_score == "0.80"
    assert got["3"].anomaly_types_detected == "None" and got["3"].reasoning is None
    rejected = {r.po_id for r in casework.rejected_responses(df).collect()}
    assert rejected == {"1", "2", "4"}


def test_confidence(spark):
    df = spark.createDataFrame([("0.8",), ("60.0",), ("85",), ("high",), (None,)], "c string")
    got = [r[0] for r in df.select(casework.normalise_confidence(F.col("c"))).collect()]
    assert got == [0.8, 0.6, 0.85, None, None]


def test_prompt_prints_missing_values(spark):
    schema = "po_id string, vendor_id string, rule_score double, severity string, risk_tier string, anomaly_rate double, filing_compliance_rate double"
    df = spark.createDataFrame([("PO1", "V1", 60.0, None, "High", 0.0005, None)], schema)
    text = casework.build_prompt(df, METRIC_PROMPT).first().prompt
    assert "Rule Score: 60.0\nSeverity: None\nRisk Tier: High\nAnomaly Rate: 0.0005\nFiling Compliance Rate: None\n" in text
    assert '{\n  "risk_level":"High",' in text


def test_guardrail_splits_without_loss(spark):
    df = spark.createDataFrame([("a", "v", 1.0), ("", "v", 1.0), (None, "v", 1.0), ("a", None, 1.0), ("a", "v", None)], "po_id string, vendor_id string, rule_score double")
    valid, rejected = casework.split_by_guardrail(df)
    assert (valid.count(), rejected.count()) == (1, 4)


def test_reasons(spark):
    df = spark.createDataFrame([(60.0, 0.4, 0.6, "Critical"), (80.0, None, None, None)], "rule_score double, filing_compliance_rate double, anomaly_rate double, risk_tier string")
    got = [(r.n_reasons, len(r.reasons)) for r in casework.risk_reasons(df).collect()]
    assert got == [(4, 4), (0, 0)]


def test_expand_rows_reaches_the_target_with_unique_ids(spark):
    small = spark.range(7).selectExpr("cast(id as string) as vendor_id", "id * 2 as v")
    got = expansion.expand_rows(small, 20, ["vendor_id"], "vendor_id", "V", 5)
    assert sorted(r.vendor_id for r in got.collect()) == [f"V{i:05d}" for i in range(1, 21)]


def test_assign_key_spreads_over_all_keys(spark):
    orders = spark.range(2000).selectExpr("concat('P', id) as po_id", "'old' as vendor_id")
    lookup = spark.range(10).selectExpr("concat('V', id) as vendor_id")
    counts = expansion.assign_key(orders, lookup, "vendor_id", "po_id", "x").groupBy("vendor_id").count().collect()
    assert len(counts) == 10
    assert all(130 < r["count"] < 270 for r in counts)


def test_merge_first_wins(spark):
    a = spark.createDataFrame([("g1", "listed")], "gstin string, reason string")
    b = spark.createDataFrame([("g1", "drawn"), ("g2", "drawn")], "gstin string, reason string")
    got = {r.gstin: r.reason for r in setops.merge_first_wins([a, b], ["gstin"]).collect()}
    assert got == {"g1": "listed", "g2": "drawn"}


def test_disambiguated_names(spark):
    df = spark.range(1).selectExpr("id", "1 as a", "id")
    assert projection.disambiguate_columns(df).columns == ["id_0", "a", "id_2"]
