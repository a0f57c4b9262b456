"""Name similarity: 2 * LCS(a, b) / (len(a) + len(b)) on lower-cased text.

Trivial rows (a side missing, both sides equal) are settled in the JVM. The rest go to an
Arrow batch function: over a table of distinct pairs (`operators.names`), or in place for a
few rows. A pure built-in form of the same score is kept as a second, independent way.
"""

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def indel_similarity(a: str, b: str) -> float:
    total = len(a) + len(b)
    if total == 0:
        return 1.0
    # Bit-parallel LCS: bit i of `open_` is cleared once a[i] takes part in the match.
    positions: dict[str, int] = {}
    for i, ch in enumerate(a):
        positions[ch] = positions.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_ = full
    for ch in b:
        hit = open_ & positions.get(ch, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return 2.0 * (len(a) - open_.bit_count()) / total


def _score_batch(left: pd.Series, right: pd.Series) -> pd.Series:
    scores = [
        None if a is None or b is None else indel_similarity(a, b) for a, b in zip(left, right)
    ]
    return pd.Series(scores, dtype="float64")


def settled_score(a: Column, b: Column, score: Column) -> Column:
    """The score where both names are known and differ; the trivial cases settle the rest."""
    x, y = F.lower(a), F.lower(b)
    return F.when(x.isNull() | y.isNull(), F.lit(0.0)).when(x == y, F.lit(1.0)).otherwise(score)


def pair_score(x: Column, y: Column) -> Column:
    """The score of lower-cased names in Arrow batches; null if one is missing."""
    return F.pandas_udf(_score_batch, "double")(x, y)


def _with_trivial_cases(a: Column, b: Column, score) -> Column:
    x, y = F.lower(a), F.lower(b)
    open_case = x != y
    return settled_score(a, b, score(F.when(open_case, x), F.when(open_case, y)))


def name_similarity(a: Column, b: Column) -> Column:
    return _with_trivial_cases(a, b, pair_score)


def name_similarity_builtin(a: Column, b: Column) -> Column:
    """The same score from built-in array functions only (a fold over LCS table rows)."""

    def score(x: Column, y: Column) -> Column:
        chars = F.when(F.length(x) > 0, F.split(x, "")).otherwise(F.array().cast("array<string>"))
        start = F.array_repeat(F.lit(0), F.length(y) + 1)

        def next_row(row: Column, ch: Column) -> Column:
            steps = F.when(F.length(y) > 0, F.sequence(F.lit(1), F.length(y))).otherwise(
                F.array().cast("array<int>")
            )

            def next_cell(cells: Column, j: Column) -> Column:
                grown = F.when(F.substring(y, j, F.lit(1)) == ch, F.get(row, j - 1) + 1)
                best = F.greatest(F.element_at(cells, -1), F.get(row, j), grown)
                return F.array_append(cells, best)

            return F.aggregate(steps, F.array(F.lit(0)), next_cell)

        lcs = F.element_at(F.aggregate(chars, start, next_row), -1)
        return F.lit(2.0) * lcs / (F.length(x) + F.length(y))

    return _with_trivial_cases(a, b, score)
