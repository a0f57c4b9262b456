"""Top-k reports, ranked lists, repeatable samples, and numbering at scale.

Numbering (`number_rows`, `running_totals`) never pulls a table into one partition. Rows
are range-partitioned on the sort columns and written once; each row's place inside its
partition is known as it is written. What remains is one offset per partition, a table as
long as the number of partitions, which is why it may be broadcast.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levyscan.functions.scalars import HASH_BITS, hash_fraction, hash_number
from levyscan.operators.keyed import lookup_join
from levyscan.sources.staging import stage

_PLACE = "_place"
_PART_SHIFT = 33  # monotonically_increasing_id keeps the partition above bit 33


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """k first rows by a total order (the caller ends it with a unique key)."""
    return df.orderBy(*order).limit(k)


def top_suspicious(flags: DataFrame, k: int = 50, below: float = 70) -> DataFrame:
    return top_k(flags.filter(F.col("rule_score") < below), k, F.desc("rule_score"), "po_id")


def ordered_counts(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(column) if by_value else counts.orderBy(F.desc("n"), column)


def rank_within(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """1, 2, 3, ... inside each group, however large: the place in the whole table, ordered by
    group first, less that of the group's first row."""
    numbered = number_rows(df, [F.col(group), *order], "_nth")
    firsts = numbered.groupBy(group).agg(F.min("_nth").alias("_first"))
    joined = lookup_join(numbered, firsts, [group], ["_nth"], null_safe=True)
    return joined.withColumn(name, F.col("_nth") - F.col("_first") + 1).drop("_nth", "_first")


def sample_fraction(df: DataFrame, fraction: float, salt: str, *keys: str) -> DataFrame:
    """Row-local sample by hash threshold: the same rows on every run."""
    return df.filter(hash_fraction(salt, *[F.col(k) for k in keys]) < fraction)


def sample_rows(df: DataFrame, n: int, salt: str, *keys: str) -> DataFrame:
    """Exactly n rows (or all, if fewer), chosen by hash order. Of a large table only the rows in a
    share of the hash range that holds about twice as many are put in order, unless they prove
    to be fewer than n."""
    ordered = df.withColumn("_hash", hash_number(salt, *[F.col(k) for k in keys]))
    rows = df.count()
    if rows > 4 * n:
        near = stage(ordered.filter(F.col("_hash") < (2 * n << HASH_BITS) // rows), "near")
        ordered = near if near.count() >= n else ordered
    return number_rows(ordered, ["_hash", *keys], "_nth").filter(F.col("_nth") <= n).drop("_hash", "_nth")


def _written_in_order(df: DataFrame, order: list[str | Column]) -> DataFrame:
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PLACE, F.monotonically_increasing_id())
    )
    return stage(placed, "ordered")


def _partition_of(place: Column) -> Column:
    return F.shiftright(place, _PART_SHIFT)


def _with_offsets(written: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Join what lies before each partition: one row per partition, by prefix sum."""
    per_part = written.groupBy(_partition_of(F.col(_PLACE)).alias("_part")).agg(
        *[total.alias(name) for name, total in totals.items()]
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "_part", *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(name) for name in totals]
    )
    return written.withColumn("_part", _partition_of(F.col(_PLACE))).join(F.broadcast(offsets), "_part")


def number_rows(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """1, 2, 3, ... over the whole table in the given total order."""
    written = _written_in_order(df, order)
    local = F.col(_PLACE) - F.shiftleft(F.col("_part"), _PART_SHIFT) + 1
    return (
        _with_offsets(written, {"_before": F.count("*")})
        .withColumn(name, F.col("_before") + local)
        .drop("_before", "_part", _PLACE)
    )


def running_totals(df: DataFrame, order: list[str | Column], sums: dict[str, str]) -> DataFrame:
    """Running sums (row included) of integer columns over the whole table; `sums` maps a
    new column to the column it adds up."""
    written = _written_in_order(df, order)
    offsets = _with_offsets(written, {f"_b_{new}": F.sum(old) for new, old in sums.items()})
    so_far = (
        Window.partitionBy("_part").orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = offsets.withColumns(
        {new: F.col(f"_b_{new}") + F.sum(old).over(so_far) for new, old in sums.items()}
    )
    return summed.drop("_part", _PLACE, *[f"_b_{new}" for new in sums])


def fixed_size_clusters(df: DataFrame, order: list[str | Column], size: int, name: str) -> DataFrame:
    """Cluster numbers 0, 1, ... of `size` neighbours each in the given order."""
    numbered = number_rows(df, order, "_nth")
    return numbered.withColumn(name, F.expr(f"(_nth - 1) div {size}")).drop("_nth")
