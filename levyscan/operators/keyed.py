"""Key-based building blocks: one row per key, lookups and counts that stand hot keys.

Hot keys. A key that holds a third of all rows would put a third of the work into one
task. Lookups and counts here never do that:

* counts are aggregated with map-side combine and joined back, in place of a window that
  would pull a whole group into one task;
* the join adds a salt to the keys that the counts show to be heavy. The number of salts
  grows with the rows of the key, so one slice has about ``ROWS_PER_SALT`` rows whatever
  the size of the table. The salt is a hash of a row identity, so a retried task gives the
  same slices;
* every key above ``ROWS_PER_SALT`` rows is on the list of heavy keys, which so has at most
  rows / ``ROWS_PER_SALT`` entries. It is broadcast if its count proves to be small.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyscan.sources.staging import stage

ROWS_PER_SALT = 1_000_000
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
TEXT_BYTES = 48  # estimate for a text column

_SALT = "_salt"
_SALTS = "_salts"


def one_per_key(df: DataFrame, keys: list[str], prefer: list[str | Column] | None = None, max_rows: int | None = None) -> DataFrame:
    """One row per key: the least by `prefer`, then by all other columns, so that the
    survivor does not hang on partition order. A missing value comes after any other.

    Keys are counted first, which moves keys alone. Rows whose key occurs once are passed on
    as they are; only the rows of repeated keys are compared, copies collapsing before the
    shuffle. Where no key is repeated the frame comes back unchanged.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    repeated = stage(repeated_keys(df, keys).select(*keys), "repeated")
    several = repeated.count()
    if not several:
        return df
    listed = _prefixed(F.broadcast(repeated) if several <= broadcast_limit(repeated, max_rows) else repeated, keys)
    same = reduce(lambda a, b: a & b, _on(keys, null_safe=True))
    once, several = df.join(listed, same, "left_anti"), df.join(listed, same, "left_semi")
    return once.unionByName(_least_row(several, keys, rest, prefer or []))


def _least_row(df: DataFrame, keys: list[str], rest: list[str], prefer: list[str | Column]) -> DataFrame:
    first = [F.col(c) if isinstance(c, str) else c for c in prefer]
    order = [F.struct(c.isNull().alias("gap"), c.alias("value")) for c in [*first, *[F.col(f"`{c}`") for c in rest]]]
    least = df.groupBy(*keys).agg(F.min(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(order)])).alias("_row"))
    place = {c: f"_row.c{len(first) + i}.value" for i, c in enumerate(rest)}
    return least.select(*[F.col(c) if c in keys else F.col(place[c]).alias(c) for c in df.columns])


def key_counts(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def repeated_keys(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Keys that occur more than once."""
    return key_counts(df, keys, name).filter(F.col(name) > 1)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Few rows, and few bytes by the width of the columns. A plain count: partial counts per
    task, and file footers alone for a stored table."""
    return df.count() <= broadcast_limit(df, max_rows)


def broadcast_limit(df: DataFrame, max_rows: int | None = None) -> int:
    """How many rows of this width may be broadcast."""
    return min(BROADCAST_ROWS if max_rows is None else max_rows, BROADCAST_BYTES // row_bytes(df))


def row_bytes(df: DataFrame) -> int:
    """Estimated width of a row: numbers and dates by eight bytes, anything else as a text."""
    plain = ("int", "bigint", "double", "float", "boolean", "date", "timestamp", "smallint", "tinyint")
    return 8 + sum(8 if kind in plain else TEXT_BYTES for _, kind in df.dtypes)


def _on(keys: list[str], null_safe: bool) -> list[Column]:
    pairs = [(F.col(k), F.col(f"_r_{k}")) for k in keys]
    return [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]


def _prefixed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_r_{k}" for k in keys})


def left_join_on(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Left join that keeps only the left side's key columns; null keys match if asked."""
    other = _prefixed(right, keys)
    condition = reduce(lambda a, b: a & b, _on(keys, null_safe))
    return left.join(other, condition, "left").drop(*[f"_r_{k}" for k in keys])


def heavy_keys(
    counts: DataFrame, keys: list[str], name: str = "n", rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """Keys that need more than one slice, with their number of slices."""
    return (
        counts.filter(F.col(name) > rows_per_salt)
        .select(*keys, F.ceil(F.col(name) / rows_per_salt).cast("int").alias(_SALTS))
    )


def spread_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    counts: DataFrame,
    identity: list[str],
    null_safe: bool = False,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Left join to a side that is unique per key, with heavy left keys cut into slices.

    `counts` holds the left row count `n` per key (keys that are surely light may be
    missing), `identity` the columns that tell the rows of one key apart. The heavy keys
    are written once; where there are none, this is a plain join.
    """
    heavy = stage(heavy_keys(counts, keys, "n", rows_per_salt), "heavy")
    if heavy.isEmpty():
        return left_join_on(left, right, keys, null_safe)
    heavy = F.broadcast(heavy) if is_small(heavy) else heavy
    salts = F.coalesce(F.col(_SALTS), F.lit(1))
    sliced = left_join_on(left, heavy, keys, null_safe=True).withColumn(
        _SALT, F.when(salts > 1, F.pmod(F.xxhash64(*identity), salts).cast("int")).otherwise(0)
    )
    copies = left_join_on(right, heavy, keys, null_safe=True).withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), salts - 1))
    )
    other = _prefixed(copies.drop(_SALTS), keys).withColumnRenamed(_SALT, "_r_salt")
    condition = reduce(lambda a, b: a & b, _on(keys, null_safe), F.col(_SALT) == F.col("_r_salt"))
    joined = sliced.join(other, condition, "left")
    return joined.drop(_SALT, _SALTS, "_r_salt", *[f"_r_{k}" for k in keys])


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    identity: list[str],
    counts: DataFrame | None = None,
    null_safe: bool = False,
    bound: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Left join to a table that is unique per key. It is broadcast when its row count
    proves to be small; else both sides are shuffled with heavy keys spread.

    `bound` may name a frame that has at least as many rows and is cheaper to count.
    """
    if is_small(right if bound is None else bound, broadcast_rows):
        return left_join_on(left, F.broadcast(right), keys, null_safe)
    known = key_counts(left, keys) if counts is None else counts
    return spread_left_join(left, right, keys, known, identity, null_safe, rows_per_salt)


def shared_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Groups of two rows or more with their size, written."""
    return stage(repeated_keys(df, keys), "groups")


def count_within(
    df: DataFrame,
    keys: list[str],
    name: str,
    identity: list[str],
    source: DataFrame | None = None,
    groups: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Add the number of rows that share the keys (null keys form a group of their own).

    Only groups of two or more are written and travel back to the rows; the others are 1 by
    definition. `source` may name a narrower frame with the same rows to count on, `groups`
    the groups as `shared_groups` has found them.
    """
    shared = shared_groups(df if source is None else source, keys) if groups is None else groups
    sizes = shared.withColumnRenamed("n", name)
    joined = lookup_join(df, sizes, keys, identity, shared, null_safe=True, **options)
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(1).cast("bigint")))


def member_flag(
    df: DataFrame, members: DataFrame, keys: list[str], name: str, identity: list[str], **options
) -> DataFrame:
    """1 where the key is in the member table, else 0; repeats there do not add rows."""
    listed = members.select(*keys).distinct().withColumn(name, F.lit(1))
    joined = lookup_join(df, listed, keys, identity, bound=members, **options)
    return joined.withColumn(name, F.coalesce(name, F.lit(0)))


def attach_director_counts(
    df: DataFrame, vendor_pans: DataFrame, bound: DataFrame | None = None, **options
) -> DataFrame:
    """Vendors per director PAN, joined to every row with that PAN; a missing PAN gets null.

    `vendor_pans` has one row per vendor: vendor_id and director_pan_1.
    """
    per_pan = (
        vendor_pans.filter(F.col("director_pan_1").isNotNull())
        .select("director_pan_1", "vendor_id")
        .distinct()
        .groupBy("director_pan_1")
        .agg(F.count("*").alias("director_vendor_count"))
    )
    limit = vendor_pans if bound is None else bound
    return lookup_join(df, per_pan, ["director_pan_1"], ["vendor_id"], bound=limit, **options)
