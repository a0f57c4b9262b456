"""Select, rename, cast, filter and null handling."""

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyscan.constants import CLEAN_CODE, FEATURES, FILING_QUARTERS, RULE_FLAGS
from levyscan.functions.scalars import as_of_date
from levyscan.schemas import ORDER_NUMBERS


def standardise(df: DataFrame, fields: list[tuple[str, str, str]]) -> DataFrame:
    """Raw headers (spaces, %, ₹, dots) to standard names and types, in one projection."""
    return df.select(
        *[F.col(f"`{header}`").try_cast(kind).alias(name) for header, name, kind in fields]
    )


def enforce_types(df: DataFrame, types: dict[str, str] = ORDER_NUMBERS) -> DataFrame:
    """Cast the named columns; a value that does not fit becomes null."""
    return df.select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def prepare_vendor_side(df: DataFrame) -> DataFrame:
    """Rename and drop what would clash once vendors sit next to orders."""
    renames = {"status": "vendor_status", "id": "vendor_row_id"}
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns}).drop(
        "ingestion_timestamp"
    )


def disambiguate_columns(df: DataFrame) -> DataFrame:
    """Give a repeated column name its position as suffix."""
    seen = Counter(df.columns)
    return df.toDF(*[f"{c}_{i}" if seen[c] > 1 else c for i, c in enumerate(df.columns)])


def bind_labels(df: DataFrame) -> DataFrame:
    """Label columns by name, whatever their physical order."""
    return df.select(
        "po_id", "anomaly_code", F.col("is_anomalous").try_cast("int").alias("is_anomalous"), "severity"
    )


def with_audit_timestamp(df: DataFrame, name: str, as_of: str | None = None) -> DataFrame:
    stamp = F.to_timestamp(F.lit(as_of)) if as_of else F.current_timestamp()
    return df.withColumn(name, stamp)


def require_keys(df: DataFrame, *keys: str) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def keep_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Keep rows whose id starts with the prefix (drops banner rows of a raw file)."""
    return df.filter(F.col(column).startswith(prefix))


def keep_matching(df: DataFrame, condition: Column, *columns: str) -> DataFrame:
    """Exception listing: the rows that meet a condition, and only the columns asked for."""
    return df.filter(condition).select(*columns)


def raised_listings(silver: DataFrame, flags: list[str] = RULE_FLAGS, severity: str = "Critical") -> DataFrame:
    """(po_id, listing) for each exception listing that an order is on: every raised flag, and
    the given severity. All listings come from one pass over the flag columns."""
    raised = [F.when(F.col(f) == 1, F.lit(f)) for f in flags]
    raised.append(F.when(F.col("severity") == severity, F.lit(f"severity {severity}")))
    return silver.select("po_id", F.explode(F.array_compact(F.array(*raised))).alias("listing"))


def fill_vendor_gaps(df: DataFrame) -> DataFrame:
    """Missing composition and filing flags count as 0 (the columns are numeric by now)."""
    return df.fillna({c: 0 for c in ["composition_flag", *FILING_QUARTERS]})


def fill_features(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    return df.fillna(0, subset=features)


def default_labels(df: DataFrame) -> DataFrame:
    """An order without a label is clean; its severity stays unknown."""
    return df.withColumns(
        {
            "is_anomalous": F.coalesce("is_anomalous", F.lit(0)),
            "anomaly_code": F.coalesce("anomaly_code", F.lit(CLEAN_CODE)),
        }
    )


def age_in_days(day: Column, as_of: str | None = None) -> Column:
    return F.datediff(as_of_date(as_of), day)
