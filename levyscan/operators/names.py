"""Name similarity over a whole table: each distinct pair of names is scored once."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyscan.functions.similarity import pair_score, settled_score
from levyscan.operators.keyed import key_counts, lookup_join
from levyscan.sources.staging import stage

_PAIR = ["_name_a", "_name_b"]


def score_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """The distinct pairs of differing names with their rows `n` and score, written. Pairs are
    made distinct per slice and then over all; each is scored once, in Arrow batches."""
    x, y = F.lower(a), F.lower(b)
    open_pairs = df.filter(x != y).select(x.alias(_PAIR[0]), y.alias(_PAIR[1]))
    pairs = stage(key_counts(open_pairs, _PAIR), "name-pairs")
    return stage(pairs.withColumn("_score", pair_score(*[F.col(c) for c in _PAIR])), "name-scores")


def with_name_similarity(
    df: DataFrame, a: str, b: str, name: str, identity: list[str], scores: DataFrame | None = None, **options
) -> DataFrame:
    """Add the similarity of two name columns.

    Pairs that need no score (a side missing, both equal) are settled in place. The scores of
    the others (`scores`, or else those of this frame's pairs) come back as a lookup: broadcast
    if it proves small, else with frequent pairs spread. Settled rows carry a key of their
    own, so that they do not meet in one task.
    """
    scored = score_pairs(df, a, b) if scores is None else scores
    x, y = F.lower(a), F.lower(b)
    apart = F.xxhash64(*identity).cast("string")
    keyed = df.withColumns(
        {_PAIR[0]: F.when(x != y, x).otherwise(apart), _PAIR[1]: F.when(x != y, y).otherwise(F.lit(""))}
    )
    joined = lookup_join(keyed, scored.drop("n"), _PAIR, identity, scored.select(*_PAIR, "n"), **options)
    return joined.withColumn(name, settled_score(F.col(a), F.col(b), F.col("_score"))).drop("_score", *_PAIR)
