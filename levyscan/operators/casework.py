"""Analyst cases: the case table, its guardrail, prompt text and response parsing.

The call to a language model is not part of this library; it sits between `build_prompt`
and `parse_responses` as any text-to-text step.
"""

from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyscan.constants import CASE_COLUMNS, SUSPICIOUS_BELOW
from levyscan.functions.scalars import plain_number_text
from levyscan.operators.keyed import lookup_join, one_per_key
from levyscan.sources.staging import stage

RESPONSE_FIELDS = [
    "risk_level",
    "anomaly_types_detected",
    "reasoning",
    "recommended_action",
    "confidence_score",
]


def attach_vendor_risk(flags: DataFrame, risk: DataFrame) -> DataFrame:
    """Tier, anomaly rate and compliance of the vendor. Of several risk rows the one with the
    highest rate is used. The side is written once, as it is counted and then joined."""
    side = one_per_key(
        risk.select("vendor_id", "risk_tier", "anomaly_rate", "filing_compliance_rate"),
        ["vendor_id"],
        prefer=[-F.col("anomaly_rate")],
    )
    return lookup_join(flags, stage(side, "vendor-risk"), ["vendor_id"], ["po_id"])


def case_table(flags: DataFrame, risk: DataFrame) -> DataFrame:
    return attach_vendor_risk(flags, risk).select(*CASE_COLUMNS)


def with_guardrail(cases: DataFrame) -> DataFrame:
    """is_valid: both ids present and not empty, and a score."""
    present = [F.coalesce(F.length(c) > 0, F.lit(False)) for c in ("po_id", "vendor_id")]
    return cases.withColumn("is_valid", present[0] & present[1] & F.col("rule_score").isNotNull())


def split_by_guardrail(cases: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = with_guardrail(cases)
    valid, rejected = checked.filter("is_valid"), checked.filter("not is_valid")
    return valid.drop("is_valid"), rejected.drop("is_valid")


def _value_text(name: str, kind: str) -> Column:
    value = F.col(name)
    if kind in ("double", "float"):
        value = plain_number_text(value)
    elif kind == "boolean":
        value = F.initcap(value.cast("string"))
    return F.coalesce(value.cast("string"), F.lit("None"))


def build_prompt(df: DataFrame, template: str, name: str = "prompt") -> DataFrame:
    """Fill a text format from the columns it names; a missing value prints as None."""
    kinds = dict(df.dtypes)
    parts = []
    for text, field, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if field:
            parts.append(_value_text(field, kinds[field]))
    return df.withColumn(name, F.concat(*parts))


def _list_text(text: Column) -> Column:
    """A JSON list of strings in the form ['a', 'b']; other values as they are."""
    items = F.from_json(text, "array<string>")
    quoted = F.transform(
        items,
        lambda item: F.when(
            item.contains("'") & ~item.contains('"'), F.concat(F.lit('"'), item, F.lit('"'))
        ).otherwise(F.concat(F.lit("'"), item, F.lit("'"))),
    )
    rendered = F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
    return F.when(F.startswith(text, F.lit("[")), rendered).otherwise(F.coalesce(text, F.lit("None")))


def with_parsed_response(df: DataFrame, response: str = "response") -> DataFrame:
    """Adds `is_parsed` and the five fields read from the text between the first { and the
    last }. Text without such a span, or with broken JSON in it, is not parsed."""
    span = F.regexp_extract(response, r"(?s)\{.*\}", 0)
    fields = ", ".join(f"{f}: string" for f in RESPONSE_FIELDS)
    # As the only element of a list, text behind the object or a second object is an error.
    listed = F.concat(F.lit("["), F.when(F.length(span) > 0, span), F.lit("]"))
    items = F.from_json(listed, f"array<struct<{fields}>>", {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    parsed = df.withColumn("_items", items)
    ok = F.coalesce(F.size("_items") == 1, F.lit(False)) & F.get("_items", F.lit(0)).isNotNull()
    parsed = parsed.withColumn("_json", F.get("_items", F.lit(0)))
    return parsed.select(
        *df.columns,
        ok.alias("is_parsed"),
        *[
            F.when(ok, _list_text(F.col(f"_json.{f}")) if f == "anomaly_types_detected" else F.col(f"_json.{f}")).alias(f)
            for f in RESPONSE_FIELDS
        ],
    )


def parse_responses(df: DataFrame, response: str = "response") -> DataFrame:
    kept = with_parsed_response(df, response).filter("is_parsed")
    return kept.select("po_id", *RESPONSE_FIELDS)


def rejected_responses(df: DataFrame, response: str = "response") -> DataFrame:
    return with_parsed_response(df, response).filter("not is_parsed").select("po_id", response)


def risk_reasons(df: DataFrame) -> DataFrame:
    """The criteria of the prompt as plain rules: which hold for this case, and how many."""
    checks = [
        (F.col("rule_score") < SUSPICIOUS_BELOW, "Rule score below 70"),
        (F.col("filing_compliance_rate") < 0.5, "Filing compliance below 0.5"),
        (F.col("anomaly_rate") > 0.5, "Anomaly rate above 0.5"),
        (F.col("risk_tier") == "Critical", "Critical risk tier"),
    ]
    found = F.filter(F.array(*[F.when(c, F.lit(t)) for c, t in checks]), lambda r: r.isNotNull())
    return df.withColumn("reasons", found).withColumn("n_reasons", F.size("reasons"))


def normalise_confidence(value: Column) -> Column:
    """Confidence to [0, 1]: values above 1 were given in percent."""
    number = value.try_cast("double")
    return F.when(number > 1, number / 100).otherwise(number)
