"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source is to give a share of the mix in proportion to its weight, as far as it has
enough: no more than `MOST_EPOCHS` times its size, what lies above is shared out again by
weight. A target of r times the source's size means floor(r) whole passes over it (complete
epochs) and then a selection of the rest: every document draws an exponential key
-ln(u) / quality, with u from a hash of its id and text size, and documents are taken by
rising key until the prefix sum of their sizes reaches what is left.

Prefix sums without one task per source: keys are mapped to `BUCKETS` ranges, sizes are added
up per source and range (map-side combined), and only the one range in which a source's
budget ends is sorted, about a `BUCKETS`-th of the source.

Defined results: a null or blank text has size 0 and nothing is taken of it; a null source is
a source of its own, last in order; repeated rows are documents of their own (equal rows are
told apart by their place in the sort, which one of two equal rows is cut makes no
difference); a source of size 0 has target 0; an empty table gives an empty table; other
columns are not read.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from levyscan.llm.common import WORD_PATTERN, only, stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
BUCKETS = 4096
MAX_SOURCES = 100_000


def text_quality(text: Column) -> Column:
    """Between 0.25 and 1: the share of a text's signs that are neither digits nor marks."""
    odd = F.length(text) - F.length(F.translate(text, "0123456789#*$%&|<>{}[]\\^~=+_@", ""))
    return F.coalesce(F.lit(1.0) - F.lit(0.75) * odd / F.greatest(F.length(text), F.lit(1)), F.lit(1.0))


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> dict[str | None, float]:
    """Words each source is to give: sizes come with their source."""
    ordered = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode("utf-32-be")))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(ordered)}
    size = dict(ordered)
    left = share * sum(size.values())
    out: dict[str | None, float] = {}
    open_sources = [s for s, _ in ordered]
    while open_sources:
        unit = left / sum(weight[s] for s in open_sources)
        full = [s for s in open_sources if weight[s] * unit > most * size[s]]
        for s in full or open_sources:
            out[s] = float(most * size[s]) if full else weight[s] * unit
            left -= out[s] if full else 0
        open_sources = [s for s in open_sources if s not in out]
    return out


def _draw(rows: DataFrame, salt: str) -> dict[str, Column]:
    """Size, key and range of a row with doc_id and text."""
    place = F.xxhash64(F.lit(salt), F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    u = (F.shiftrightunsigned(place, 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    key = -F.log(u) / text_quality(F.col("text"))
    return {
        "size": F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long"),
        "key": key,
        "bucket": F.least(F.floor((F.lit(1.0) - F.exp(-key)) * BUCKETS), F.lit(BUCKETS - 1)).cast("int"),
    }


def _planned(rows: DataFrame, weights: tuple[int, ...], share: float, most: int, salt: str) -> tuple[DataFrame, DataFrame]:
    """The drawn rows, written, and per source (at most MAX_SOURCES of them): size, target,
    epochs, the budget behind them, and the range in which it ends."""
    drawn = stage(rows.select("doc_id", "source", *[c.alias(n) for n, c in _draw(rows, salt).items()]), "drawn")
    per_bucket = stage(drawn.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "buckets")
    sizes = per_bucket.groupBy("source").agg(F.sum("words").alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    goal = targets([(r.source, r.words) for r in sizes], weights, share, most)
    plan = []
    for r in sizes:
        epochs = min(most, int(goal[r.source] // r.words)) if r.words else 0
        plan.append((r.source, r.words, goal[r.source], epochs, int(round(goal[r.source])) - epochs * r.words if r.words else 0))
    plan_table = rows.sparkSession.createDataFrame(plan, "_source string, source_size long, target double, epochs long, budget long")

    so_far = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = per_bucket.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
    ends = (
        before.join(F.broadcast(plan_table), F.col("source").eqNullSafe(F.col("_source")))
        .filter("before <= budget and before + words > budget")
        .groupBy("source")
        .agg(F.min("bucket").alias("last"), F.min("before").alias("before"))
    )
    marks = plan_table.join(ends, F.col("_source").eqNullSafe(F.col("source")), "left").drop("source")
    return drawn, stage(marks, "marks")


def _edges(drawn: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All drawn rows with their source's marks, and those in the range where a budget ends,
    with what their source gives ahead of them."""
    planned = drawn.join(F.broadcast(marks), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    inner = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = planned.filter(F.col("bucket") == F.col("last")).withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(inner), F.lit(0)))
    return planned, edge


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_EPOCHS,
    salt: str = "mix",
) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs, taken for every row of `docs`.

    `epochs` counts the whole passes, `taken` the words with repeats; the document in which a
    source's budget ends is taken in part.
    """
    drawn, marks = _planned(only(docs, doc_id=id_col, text=text_col, source=source_col), weights, share, most, salt)
    planned, edge = _edges(drawn, marks)
    part = F.greatest(F.least(F.col("size"), F.col("budget") - F.col("ahead")), F.lit(0))
    whole = F.when((F.col("budget") > 0) & (F.col("last").isNull() | (F.col("bucket") < F.col("last"))), F.col("size")).otherwise(0)
    rest = planned.filter(F.col("last").isNull() | (F.col("bucket") != F.col("last")))

    def taken(frame: DataFrame, extra: Column) -> DataFrame:
        return frame.select(
            "doc_id", "source", "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken")
        )

    return taken(rest, whole).unionByName(taken(edge, part))


def mixed_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_EPOCHS,
    salt: str = "mix",
) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, whole: the document in which a
    source's budget ends is in if at least half of it fits. The rows stay where they are; each
    source's last key is all that travels to them. Only rows of that key, equal in id and text,
    are counted together, so that as many of them are in as fit."""
    named = only(docs, doc_id=id_col, text=text_col, source=source_col)
    drawn, marks = _planned(named, weights, share, most, salt)
    _, edge = _edges(drawn, marks)
    fits = F.col("ahead") + F.col("size") / 2 <= F.col("budget")
    per_key = edge.filter("budget > 0").groupBy("source", "key").agg(F.count_if(fits).alias("n"), F.count("*").alias("of"))
    last = per_key.filter("n > 0").groupBy("source").agg(F.max(F.struct("key", "n", "of")).alias("end"))
    keyed = stage(
        marks.join(last, F.col("_source").eqNullSafe(F.col("source")), "left")
        .select(
            F.col("_source").alias("__source"),
            F.col("epochs").alias("__epochs"),
            F.col("budget").alias("__budget"),
            F.col("last").alias("__last"),
            F.col("end.key").alias("__last_key"),
            F.col("end.n").alias("__last_rows"),
            F.col("end.of").alias("__last_of"),
        ),
        "last-keys",
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    inner = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{source_col}`").alias("source"), row)
    made = _draw(inner, salt)
    inner = inner.select("__row", "source", *[made[c].alias(c) for c in ("key", "bucket", "size")])
    joined = inner.join(F.broadcast(keyed), F.col("source").eqNullSafe(F.col("__source"))).filter("size > 0")
    in_last = (F.col("__budget") > 0) & (F.col("bucket") == F.col("__last")) & F.col("__last_key").isNotNull()
    before_last = (F.col("__budget") > 0) & (F.col("__last").isNull() | (F.col("bucket") < F.col("__last")))
    at_end = F.coalesce(in_last & (F.col("key") == F.col("__last_key")) & (F.col("__last_rows") < F.col("__last_of")), F.lit(False))
    selected = F.coalesce(before_last | (in_last & (F.col("key") <= F.col("__last_key"))), F.lit(False))

    def repeated(frame: DataFrame, copies: Column) -> DataFrame:
        counted = frame.withColumn("__copies", copies.cast("int")).filter("__copies > 0")
        return counted.select("__row", F.explode(F.sequence(F.lit(1), "__copies")).alias("__copy")).select("__row.*")

    rest = repeated(joined.filter(~at_end), F.col("__epochs") + selected.cast("int"))
    if keyed.filter("__last_rows < __last_of").isEmpty():
        return rest
    # Of the rows that tie where a budget ends, not all fit: equal ones are counted, and the
    # first `__last_rows` of them, by a digest of all columns, are in once more.
    ties = joined.filter(at_end).withColumn("__digest", F.sha2(F.to_json("__row").cast("binary"), 256))
    groups = ties.groupBy("__source", "__digest").agg(
        F.count("*").alias("__n"), F.first("__row").alias("__row"), F.first("__epochs").alias("__epochs"), F.first("__last_rows").alias("__last_rows")
    )
    ahead = Window.partitionBy("__source").orderBy("__digest").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("__last_rows") - F.coalesce(F.sum("__n").over(ahead), F.lit(0))
    groups = groups.withColumn("__in", F.greatest(F.least(F.col("__n"), room), F.lit(0)))
    return rest.unionByName(repeated(groups, F.col("__epochs") * F.col("__n") + F.col("__in")))
