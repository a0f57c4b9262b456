import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from levyscan.functions import scalars
from levyscan.functions.similarity import (
    indel_similarity,
    name_similarity,
    name_similarity_builtin,
)


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(before[j - 1] + 1 if x == y else max(before[j], row[-1]))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcé x", max_size=90), st.text(alphabet="abcé x", max_size=90))
def test_similarity_matches_the_definition(a, b):
    score = indel_similarity(a, b)
    total = len(a) + len(b)
    assert score == (2.0 * plain_lcs(a, b) / total if total else 1.0)
    assert score == indel_similarity(b, a)
    assert 0.0 <= score <= 1.0
    assert indel_similarity(a, a) == 1.0


def test_both_similarity_forms_agree(spark):
    names = ["Acme Steel Pvt Ltd", "ACME STEEL", "XYZ TRADING COMPANY", "", None, "Café Noir", "a"]
    pairs = spark.createDataFrame([(x, y) for x in names for y in names], "a string, b string")
    rows = pairs.select(
        "a",
        "b",
        name_similarity(F.col("a"), F.col("b")).alias("batch"),
        name_similarity_builtin(F.col("a"), F.col("b")).alias("builtin"),
    ).collect()
    for r in rows:
        assert r.batch == r.builtin, r
        if r.a is None or r.b is None:
            assert r.batch == 0.0
        elif r.a.lower() == r.b.lower():
            assert r.batch == 1.0
    assert any(0.21 < r.batch < 0.22 for r in rows if r.a == "XYZ TRADING COMPANY" and r.b == "Acme Steel Pvt Ltd")


def test_dates_in_both_styles_and_bad_ones(spark):
    days = ["05/03/2024", "2024-03-05", "31/02/2024", "soon", None]
    rows = spark.createDataFrame([(d,) for d in days], "d string").select(scalars.parse_date(F.col("d")).alias("d"))
    assert [r.d for r in rows.collect()] == [dt.date(2024, 3, 5), dt.date(2024, 3, 5), None, None, None]


def test_small_helpers(spark):
    got = one(
        spark,
        whole=scalars.whole_number(F.lit("1.0")),
        broken=scalars.whole_number(F.lit("many")),
        tick=scalars.mark_to_flag(F.lit("✔")),
        cross=scalars.mark_to_flag(F.lit("✘")),
        other=scalars.mark_to_flag(F.lit("maybe")),
        wide=scalars.padded_id("V", F.lit(1234567), 5),
        code=scalars.remap_code(F.lit("FRD-006")),
        zero=scalars.safe_ratio(F.lit(5.0), F.lit(0.0)),
        state=scalars.state_name(F.lit("29")),
        nowhere=scalars.state_name(F.lit("99")),
        tiny=scalars.plain_number_text(F.lit(0.00045)),
        plain=scalars.plain_number_text(F.lit(60.0)),
        half=scalars.round_half_up(F.lit(2.675)),
    )
    assert got == {
        "whole": 1,
        "broken": None,
        "tick": 1,
        "cross": 0,
        "other": 0,
        "wide": "V1234567",
        "code": "FRD-002",
        "zero": 0.0,
        "state": "KARNATAKA",
        "nowhere": None,
        "tiny": "0.00045",
        "plain": "60.0",
        "half": 2.68,
    }


def test_hash_fraction_is_uniform_and_salted(spark):
    rows = spark.range(20000).select(
        scalars.hash_fraction("a", F.col("id")).alias("a"), scalars.hash_fraction("b", F.col("id")).alias("b")
    )
    got = rows.agg(F.min("a"), F.max("a"), F.avg("a"), F.corr("a", "b")).first()
    assert 0 <= got[0] and got[1] < 1
    assert abs(got[2] - 0.5) < 0.01
    assert abs(got[3]) < 0.03
