import datetime as dt

import pytest
from pyspark.sql import functions as F

from levyscan.operators import aggregates, models, rules


def values(spark, schema, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(
    "schema, rows, rule, want",
    [
        ("name_sim_score double", [(0.85,), (0.8499,), (None,)], rules.name_mismatch, [0, 1, 0]),
        ("spike_ratio double", [(3.0,), (3.01,), (None,)], rules.value_spike, [0, 1, 0]),
        ("total_amount double, ewb_number string", [(50000.0, None), (50000.01, None), (60000.0, "E")], rules.missing_ewb, [0, 1, 0]),
        ("total_amount double", [(500000.0,), (500000.5,), (None,)], rules.high_value_invoice_flag, [0, 1, 0]),
        ("anomaly_rate double", [(0.2,), (0.1,), (0.05,), (0.0499,)], rules.vendor_risk_tier, ["Critical", "High", "Medium", "Low"]),
        ("rule_fail_count int", [(6,), (4,), (2,), (1,)], rules.severity_dashboard, ["Critical", "High", "Medium", "Low"]),
        ("director_vendor_count bigint", [(1,), (2,), (None,)], rules.director_overlap_flag, [0, 1, 0]),
        ("rule_fail_count int", [(0,), (3,), (10,)], rules.rule_score, [100.0, 70.0, 0.0]),
        ("buyer_state string, buyer_gstin string", [("karnataka", "29X"), ("Goa", "29X"), (None, "29X"), ("Goa", "99X")], rules.state_mismatch, [0, 1, 0, 0]),
        (
            "cgst_rate double, sgst_rate double, igst_rate double, gst_rate double",
            [(9.0, 9.0, 0.0, 18.0), (9.0, 9.0, 18.0, 18.0), (9.0, 9.0, 0.0, None)],
            rules.rate_mismatch,
            [0, 1, 0],
        ),
    ],
)
def test_boundaries(spark, schema, rows, rule, want):
    assert values(spark, schema, rows, rule()) == want


def test_late_invoice_needs_more_than_thirty_days(spark):
    start = dt.date(2024, 1, 1)
    rows = [(start, start + dt.timedelta(days=30)), (start, start + dt.timedelta(days=31)), (start, None)]
    assert values(spark, "po_date date, invoice_date date", rows, rules.late_invoice()) == [0, 1, 0]


def test_filings(spark):
    schema = ", ".join(f"filing_history_q{q} int" for q in range(1, 7))
    rows = [(1, 1, 1, 1, 0, 0), (1, 1, 1, 0, 0, 0), (None, 1, 1, 1, 1, 1)]
    assert values(spark, schema, rows, rules.vendor_non_filer()) == [0, 1, 0]
    assert values(spark, schema, rows, rules.filing_compliance_rate()) == [4 / 6, 0.5, None]


def test_spike_ratio_without_history(spark):
    rows = [(100.0, 0.0), (100.0, None), (100.0, 30.0)]
    assert values(spark, "total_amount double, avg_po_value double", rows, rules.spike_ratio()) == [0.0, 0.0, 3.33]


def test_history_as_average_and_as_total(spark):
    history = spark.createDataFrame([("V1", "2024-01", 100.0, 4), ("V1", "2024-01", 50.0, 1)], "vendor_id string, year_month string, total_po_value double, po_count bigint")
    average = aggregates.merge_history(history).first()
    assert (average.total_po_value, average.po_count) == (75.0, 2.5)
    total = aggregates.merge_history(history, "total").first()
    assert (total.total_po_value, total.po_count) == (450.0, 5.0)


def test_missing_invoice_numbers_can_be_ignored(spark):
    rows = [("G", None, 2024, 1, "P1"), ("G", None, 2024, 1, "P2"), ("G", "I1", 2024, 1, "P3")]
    df = spark.createDataFrame(rows, "gstin string, invoice_number string, year int, month int, po_id string")
    grouped = {r.po_id: r.invoice_dup_count for r in rules.add_duplicate_counts(df).collect()}
    assert grouped == {"P1": 2, "P2": 2, "P3": 1}
    ignored = {r.po_id: r.invoice_dup_count for r in rules.add_duplicate_counts(df, null_invoice="ignore").collect()}
    assert ignored == {"P1": 0, "P2": 0, "P3": 1}


def test_probability_tiers_and_threshold(spark):
    rows = [(0.85,), (0.7,), (0.5,), (0.35,), (0.3499,)]
    assert values(spark, "p double", rows, models.probability_tier(F.col("p"))) == ["Critical", "High", "Medium", "Low", "Low"]
    assert values(spark, "p double", rows, models.decide(F.col("p"), 0.35)) == [1, 1, 1, 1, 0]
