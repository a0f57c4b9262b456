"""Unions and row replacement."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyscan.operators.keyed import one_per_key


def append_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def append_by_position(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.union(b), frames)


def merge_first_wins(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union that keeps one row per key; an earlier frame wins over a later one."""
    ranked = [df.withColumn("_source", F.lit(i)) for i, df in enumerate(frames)]
    return one_per_key(append_by_name(*ranked), keys, prefer=["_source"]).drop("_source")


def rows_without(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(other.select(*keys), keys, "left_anti")


def replace_rows(df: DataFrame, rewritten: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with these keys are taken from `rewritten` instead."""
    return append_by_name(rows_without(df, rewritten, keys), rewritten.select(*df.columns))
