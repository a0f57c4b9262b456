"""Readers and writers. Schemas are declared, never inferred."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from levyscan.operators.projection import standardise
from levyscan.schemas import raw_schema


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header row. Columns bind by position to the declared schema and the
    header is checked against it."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


_CORRUPT = "_corrupt_line"


def read_checked(spark: SparkSession, path: str, fields: list[tuple[str, str, str]], name: str) -> tuple[DataFrame, DataFrame]:
    """Raw CSV under its declared fields, as (standardised rows, quarantine).

    A line goes into quarantine, (input, reason, line), if it has too few or too many values,
    or if a value does not fit its type; the reason names the first such column. Nothing is
    dropped: each line is in one of the two. A file whose header differs is an error.
    """
    schema = StructType([*raw_schema(fields).fields, StructField(_CORRUPT, StringType())])
    # Whole lines are parsed whatever columns are asked for, else a short line could pass.
    options = {"header": True, "enforceSchema": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "columnPruning": False}
    rows = spark.read.schema(schema).options(**options).csv(path)
    misfits = [
        F.when(F.col(f"`{header}`").isNotNull() & F.col(f"`{header}`").try_cast(kind).isNull(), F.lit(column))
        for header, column, kind in fields
        if kind != "string"
    ]
    keyed = F.when(F.col(f"`{fields[0][0]}`").isNotNull(), F.lit("number of values")).otherwise(F.lit("number of values, no key"))
    reason = F.when(F.col(_CORRUPT).isNotNull(), keyed)
    reason = F.coalesce(reason, *[F.concat(F.lit("type of "), m) for m in misfits])
    told = rows.withColumn("_reason", reason)
    values = F.to_csv(F.struct(*[F.col(f"`{header}`") for header, _, _ in fields]))
    bad = told.filter("_reason is not null").select(
        F.lit(name).alias("input"), F.col("_reason").alias("reason"), F.coalesce(F.col(_CORRUPT), values).alias("line")
    )
    return standardise(told.filter("_reason is null"), fields), bad


def read_layer(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{table}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_layer(df: DataFrame, base: str, table: str) -> str:
    path = f"{base.rstrip('/')}/{table}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_partitioned(
    df: DataFrame, path: str, *by: str, max_records_per_file: int = 5_000_000
) -> str:
    """Hive-partitioned Parquet.

    Rows are rebalanced on the partition columns: small values share a task and give few
    files, and adaptive execution cuts a value that holds a large share of all rows into
    many tasks of the advisory size.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*by)
        .parquet(path)
    )
    return path


def overwrite_values(df: DataFrame, path: str, *by: str, max_records_per_file: int = 5_000_000) -> str:
    """Replace only the partition values that occur in the frame; the files of all others stay
    untouched (dynamic partition overwrite)."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*by)
        .parquet(path)
    )
    return path


def save_table(df: DataFrame, name: str) -> str:
    """Managed catalog table in Parquet; an existing table and its schema are replaced."""
    df.write.mode("overwrite").format("parquet").option("overwriteSchema", True).saveAsTable(name)
    return name


def export_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
