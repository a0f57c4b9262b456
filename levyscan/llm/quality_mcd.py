"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Each text gets a few counts (words, their code points, marks, repeated lines, words inside
repeated three-word windows). Base rules reject short and repetitive texts. The others become
vectors of transformed statistics, and for each language and source a minimum covariance
determinant estimate says what is usual there: starting from medians and absolute deviations,
concentration steps keep the `KEPT_SHARE` of rows that lie nearest (by Mahalanobis distance)
and estimate centre and covariance from them anew; of two starts the one with the smaller
determinant wins. Rows that lie further than the cut-off from the centre are rejected.

A group of fewer than `MIN_GROUP` rows that pass the base rules takes the estimate of its
language, and that of all rows where the language has too few as well. Statistics that hardly vary keep a least spread
(`FLOORS`), so that a group of clean texts does not make every small oddity an outlier.

The estimates are tables with a row per group. They are joined by broadcast after their
count has been checked, else by shuffle; the rows themselves are aggregated with map-side
combine, so a large group never meets in one task.

Three-word windows are told apart by 64-bit hashes inside one text (two of n windows collide
with a chance below n^2 / 2^65).

Defined results: a null or blank text has all counts 0 and fails the base rules; a null
language or source is a group of its own; repeated rows get a row each; an empty table gives
an empty table; other columns are not read.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyscan.llm.common import WORD_BREAKS, only, stage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MARKS = "#*$%&|<>"
MIN_GROUP = 200
KEPT_SHARE = 0.75
STEPS = 3
CUTOFF = 60.0  # of the squared distance; the 99.9999 % point of a normal sample lies near 36
MAX_BROADCAST_GROUPS = 100_000
FEATURES = ("f_length", "f_word", "f_marks", "f_lines", "f_repeats")
FLOORS = (0.6, 0.25, 0.35, 0.35, 0.15)
_BREAK_CHARS = " \t\n\x0b\x0c\r"


def text_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The counts of each text, with the columns `keep`. Arrays are columns of their own, so
    that no step works one out again for each element of another."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        *keep,
        text.alias("text"),
        F.filter(F.split(text, f"[{WORD_BREAKS}]+"), lambda w: w != F.lit("")).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.translate(x, _BREAK_CHARS, "") != F.lit("")).alias("lines"),
    )
    counted = split.select(
        *keep,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", _BREAK_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", MARKS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(
            F.when(F.size("words") > 3, F.sequence(F.lit(1), F.size("words") - 2)),
            lambda i: F.xxhash64(F.element_at("words", i), F.element_at("words", i + 1), F.element_at("words", i + 2)),
        ).alias("windows"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    # Windows in the order of their hashes, where one occurs twice; equal ones are neighbours.
    ordered = counted.select(
        *keep,
        *counts,
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.arrays_zip(F.col("windows").alias("h"), F.sequence(F.lit(1), F.size("windows")).alias("i"))),
        ).alias("ordered"),
    )

    def same(j: Column, w: Column) -> Column:
        return F.coalesce(F.get("ordered", j).getField("h") == w.getField("h"), F.lit(False))

    places = ordered.select(
        *keep,
        *counts,
        F.sort_array(
            F.filter(
                F.transform("ordered", lambda w, j: F.when(same(j - 1, w) | same(j + 1, w), w.getField("i"))), lambda i: i.isNotNull()
            )
        ).alias("places"),
    )
    # A window adds the words that the next one does not hold.
    added = F.transform("places", lambda p, j: F.least(F.coalesce(F.get("places", j + 1) - p, F.lit(3)), F.lit(3)))
    return places.select(
        *keep, *counts, F.coalesce(F.aggregate(added, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long").alias("n_repeat_words")
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))


def features() -> dict[str, Column]:
    """The vector: length, word length, marks, repeated lines and repeated words, each put on
    a scale on which ordinary texts spread evenly."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "f_length": F.log(words),
        "f_word": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words) * 4,
        "f_marks": F.asinh(F.col("n_symbols") * 100.0 / words),
        "f_lines": F.asinh(F.col("n_dup_lines") * 300.0 / words),
        "f_repeats": F.sqrt(F.col("n_repeat_words") / words) * 2,
    }


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]


def _with_factor(estimates: DataFrame) -> DataFrame:
    """Group rows with centres m_i and covariances c_i_j to centres and factors, one column
    after the other so that no expression grows."""
    size = range(len(FEATURES))
    out = estimates
    for i, j in _pairs():
        rest = F.col(f"c_{i}_{j}") + (F.lit(FLOORS[i] ** 2) if i == j else F.lit(0.0))
        for k in range(j):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
        out = out.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l_{j}_{j}"))
    log_det = reduce(lambda a, b: a + b, [F.log(F.col(f"l_{i}_{i}")) for i in size])
    return out.withColumn("log_det", log_det).drop(*[f"c_{i}_{j}" for i, j in _pairs()])


def _with_distance(rows: DataFrame, name: str = "d2") -> DataFrame:
    """Squared Mahalanobis distance by forward substitution."""
    out, made = rows, []
    for i, f in enumerate(FEATURES):
        rest = F.col(f) - F.col(f"m_{i}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"z_{k}")
        out = out.withColumn(f"z_{i}", rest / F.col(f"l_{i}_{i}"))
        made.append(f"z_{i}")
    return out.withColumn(name, reduce(lambda a, b: a + b, [F.col(z) * F.col(z) for z in made])).drop(*made)


def _join_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    small = groups.count() <= MAX_BROADCAST_GROUPS
    return rows.join(F.broadcast(groups) if small else groups, ["level", "g_lang", "g_source"])


def _moments(rows: DataFrame) -> DataFrame:
    """Centre and covariance of each group."""
    aggregates = [F.avg(f).alias(f"m_{i}") for i, f in enumerate(FEATURES)]
    aggregates += [F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c_{i}_{j}") for i, j in _pairs()]
    return rows.groupBy("level", "g_lang", "g_source").agg(*aggregates)


def _first_estimates(rows: DataFrame, wide: bool) -> DataFrame:
    """Medians with deviations around them, or plain quantile spreads, without correlation."""
    at = [0.5, 0.1587, 0.8413] if wide else [0.5, 0.25, 0.75]
    scale = 2.0 if wide else 1.349
    quantiles = [F.percentile_approx(f, F.array(*[F.lit(a) for a in at]), 1000).alias(f"q_{i}") for i, f in enumerate(FEATURES)]
    out = rows.groupBy("level", "g_lang", "g_source").agg(*quantiles)
    centre = {f"m_{i}": F.get(f"q_{i}", F.lit(0)) for i in range(len(FEATURES))}
    spread = {
        f"c_{i}_{j}": F.pow((F.get(f"q_{i}", F.lit(2)) - F.get(f"q_{i}", F.lit(1))) / scale, F.lit(2)) if i == j else F.lit(0.0) for i, j in _pairs()
    }
    return out.withColumns({**centre, **spread}).select("level", "g_lang", "g_source", *centre, *spread)


def _concentrate(rows: DataFrame, estimates: DataFrame, steps: int) -> DataFrame:
    """Concentration steps: the nearest share of each group gives the next estimate."""
    groups = stage(_with_factor(estimates), "mcd")
    for _ in range(steps):
        near = _with_distance(_join_groups(rows, groups)).select("level", "g_lang", "g_source", *FEATURES, "d2")
        limit = stage(near.groupBy("level", "g_lang", "g_source").agg(F.percentile_approx("d2", F.lit(KEPT_SHARE), F.lit(1000)).alias("most")), "mcd-limit")
        groups = stage(_with_factor(_moments(_join_groups(near, limit).filter("d2 <= most"))), "mcd")
    return groups


def estimates(counted: DataFrame, steps: int = STEPS) -> DataFrame:
    """Centre, factor and size of each group on three levels: language and source, language,
    and all rows."""
    vectors = counted.filter(~base_failed()).select("lang", "source", *[c.alias(n) for n, c in features().items()])
    levels = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("level")
    rows = vectors.select("lang", "source", *FEATURES, levels).select(
        "level",
        F.when(F.col("level") < 2, F.coalesce(F.concat(F.lit("="), "lang"), F.lit("?"))).otherwise("*").alias("g_lang"),
        F.when(F.col("level") < 1, F.coalesce(F.concat(F.lit("="), "source"), F.lit("?"))).otherwise("*").alias("g_source"),
        *FEATURES,
    )
    rows = stage(rows, "vectors")
    one, two = (_concentrate(rows, _first_estimates(rows, wide), steps) for wide in (False, True))
    other = two.select("level", "g_lang", "g_source", F.struct(*[c for c in two.columns if c not in ("level", "g_lang", "g_source")]).alias("second"))
    mine = one.select("level", "g_lang", "g_source", F.struct(*[c for c in one.columns if c not in ("level", "g_lang", "g_source")]).alias("first"))
    better = F.when(F.col("first.log_det") <= F.col("second.log_det"), F.col("first")).otherwise(F.col("second"))
    chosen = mine.join(other, ["level", "g_lang", "g_source"]).select("level", "g_lang", "g_source", better.alias("e")).select("level", "g_lang", "g_source", "e.*")
    sizes = rows.groupBy("level", "g_lang", "g_source").agg(F.count("*").alias("members"))
    return stage(chosen.join(sizes, ["level", "g_lang", "g_source"]), "mcd-chosen")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, the counts, base_failed, distance (squared, null if base_failed) and kept for
    every row of `docs`."""
    docs = only(docs, doc_id=id_col, text=text_col, lang=lang_col, source=source_col)
    counted = stage(text_counts(docs, ["doc_id", "lang", "source"]), "counts")
    chosen = estimates(counted)
    keyed = counted.withColumns(
        {
            "base_failed": base_failed(),
            "k_lang": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("?")),
            "k_source": F.coalesce(F.concat(F.lit("="), "source"), F.lit("?")),
            **features(),
        }
    )
    # The level that each group uses: the first that is large enough.
    fine = chosen.filter("level = 0")
    large = [chosen.filter((F.col("level") == level) & (F.col("members") >= MIN_GROUP)) for level in (0, 1)]
    used = (
        fine.select(F.col("g_lang").alias("k_lang"), F.col("g_source").alias("k_source"))
        .join(large[0].select(F.col("g_lang").alias("k_lang"), F.col("g_source").alias("k_source"), F.lit(0).alias("own")), ["k_lang", "k_source"], "left")
        .join(large[1].select(F.col("g_lang").alias("k_lang"), F.lit(1).alias("by_lang")), "k_lang", "left")
        .withColumn("level", F.coalesce("own", "by_lang", F.lit(2)))
        .withColumn("g_lang", F.when(F.col("level") < 2, F.col("k_lang")).otherwise("*"))
        .withColumn("g_source", F.when(F.col("level") < 1, F.col("k_source")).otherwise("*"))
        .drop("own", "by_lang")
    )
    groups = stage(used.join(chosen.drop("members"), ["level", "g_lang", "g_source"]).drop("level", "g_lang", "g_source", "log_det"), "mcd-used")
    side = F.broadcast(groups) if groups.count() <= MAX_BROADCAST_GROUPS else groups
    measured = _with_distance(keyed.join(side, ["k_lang", "k_source"], "left"))
    return measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.when(~F.col("base_failed"), F.col("d2")).alias("distance"),
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True))).alias("kept"),
    )
