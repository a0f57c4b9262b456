import pytest

import __spark_entry__ as contract
import compare
from levyscan.checks import ORACLES, QUERIES
from conftest import SMALL

# One or two of each group; compare.py runs all of them.
SAMPLE = [
    "pl3_silver",
    "pl5_gold_vendor_risk",
    "src1_read_csv",
    "snk2_write_partitioned",
    "snk3_save_table",
    "prj1_standardise",
    "flt5_repeated_keys",
    "jn5_history",
    "jn12_positional_left",
    "ag6_frequencies",
    "ag13_executive_kpis",
    "wn1_duplicate_count",
    "wn4_sequential_ids",
    "st6_sample_rows",
    "ru6_name_similarity",
    "ru6_name_similarity_builtin",
    "ml2_exact_split",
    "ml11_roc_points",
    "ml12_comparison",
    "ai3_metric_prompt",
    "ai4_parse_responses",
    "xp6_duplicate_rows",
]


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    df = contract.queries()[name](spark, SMALL)
    got = compare.rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = compare.duck(SMALL).execute(contract.oracle_sql()[name])
    want = compare.rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got == want
    assert compare.type_gaps(df, cursor) == {}


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert "risk_tier" in df.columns
