"""N-gram Jaccard join: which texts share at least 75 % of their word shingles.

Documents by shingles form a sparse incidence matrix. Its product with its own transpose
holds the overlap of every two documents; the join accumulates just the part of it that can
still reach the bound, block by block (a block is a partition of the shingles):

1. Texts with the same set are one class; all later work is between classes. The number of
   a class comes from its set (64 bits and the set's size: two different sets of one size
   share a number with a chance of 2^-64).
2. Columns are put in one order for all documents: rare shingles first, shingles that many
   documents share last. Two sets that overlap enough must meet in the first
   ``size - ceil(0.75 * size) + 1`` columns of both, so only those are multiplied. The list
   of frequent shingles only sets the order, so it may be bounded and approximate.
3. Columns in which many classes meet (near copies in their thousands) are not multiplied
   out: each class is first compared with a few hubs of the column, among them those
   that have least besides what the column's classes share, and classes that prove
   to be linked are one component from then on.
4. All remaining pairs of different components in a column are multiplied out, but for
   those whose sets differ too much: two sets must be of like size, must have enough columns
   left from the common one on (none before the first common one is shared), and each class
   has a bitmap of the parities of its shingles by hash: two sets differ in at least as many
   shingles as their bitmaps in bits. The overlap counts of the rest are added up over the
   columns, and a pair is dropped when its count plus what the rest of its sets could add
   stays below the bound given by the two sizes. No bound can drop a linked pair.
5. What is left is counted exactly on the whole sets, read again from the texts.

Step 4 sees every pair that is not yet in one component, so no link between components is
lost, whatever the hubs were.

Defined results: a null or blank text has an empty set and is linked with nothing; a text of
fewer than five words is one shingle; rows with one doc_id are separate rows that get their
own class each; a null doc_id takes part, but never names a component unless all its members
are null; an empty table gives an empty table; other columns are not read.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from levyscan.llm import shingles as sh
from levyscan.llm.common import only, restrict, slices, stage, unstage
from levyscan.llm.components import connected_components

PERCENT = 75
ORDERED_SHINGLES = 500_000  # length of the list of frequent shingles, a bounded table
FREQUENT_FROM = 6
LARGE_COLUMN = 8  # from so many classes on, hubs come first
HUBS = 8
NEAREST_HUBS = 16  # of each class, by shared columns
BITMAP_WORDS = 8  # of 64 bits each
SLICE_BYTES = 1 << 18  # of text at once; words and shingles take some 45 times as much
COUNTED_AT_ONCE = 500_000  # shingles whose repeats a task counts together
_LEVEL_STEP = 2
_LEVELS = 7


def _required(size: Column, other: Column, percent: int) -> Column:
    """Least overlap of two sets of these sizes that are linked."""
    return F.ceil((size + other) * percent / F.lit(100.0 + percent) - F.lit(1e-9))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def frequent_shingles(docs: DataFrame, longest: int = ORDERED_SHINGLES, least: int = FREQUENT_FROM) -> np.ndarray:
    """The most frequent shingles and how often they were met, as rows (shingle, level).

    A shingle counts where it occurs twice or more in one slice of the input, so a task sends
    few rows. The list sets the order of the columns and nothing else.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n > 1
            return pa.record_batch({"key": keys[keep].astype(np.int64), "n": n[keep].astype(np.int64)})

        for batch in slices(batches, 0, SLICE_BYTES):
            sets = sh.shingle_sets(batch.column(0))
            held.extend(sets)
            size += sum(map(len, sets))
            if size > COUNTED_AT_ONCE:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    counts = docs.select("text").mapInArrow(counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    top = counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "key").limit(longest).toArrow()
    keys = top.column("key").to_numpy().astype(np.uint64)
    levels = np.minimum(_LEVELS, 1 + np.log2(top.column("n").to_numpy() / least) / _LEVEL_STEP).astype(np.uint64)
    order = np.argsort(keys)
    return np.stack([keys[order], levels[order]])


def _columns(shingles: np.ndarray, frequent: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Column numbers in the common order: the level in the top bits, then the shingle."""
    keys, levels = frequent
    if not len(keys):
        return shingles
    maybe = np.flatnonzero(seen[shingles & np.uint64(len(seen) - 1)])
    if not len(maybe):
        return shingles
    found = np.minimum(np.searchsorted(keys, shingles[maybe]), len(keys) - 1)
    hit = keys[found] == shingles[maybe]
    out = shingles.copy()
    out[maybe[hit]] |= levels[found[hit]] << np.uint64(sh.HASH_BITS)
    out.sort()
    return out


def _seen_table(frequent: np.ndarray) -> np.ndarray:
    seen = np.zeros(1 << 22, dtype=bool)
    seen[frequent[0] & np.uint64(len(seen) - 1)] = True
    return seen


def parity_bitmap(shingles: np.ndarray) -> np.ndarray:
    """For each value of the hash's low bits, whether an odd number of shingles has it."""
    width = 64 * BITMAP_WORDS
    odd = np.bincount((shingles % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def classes(docs: DataFrame, frequent: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """(doc_id, class, n, prefix, bits) for every row. Of equal sets in one slice only the
    first has a prefix and a bitmap; a document without words has neither class nor prefix."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _seen_table(frequent)
        for batch in slices(batches, 1, SLICE_BYTES):
            numbers, sizes, prefixes, bitmaps, met = [], [], [], [], set()
            for s in sh.shingle_sets(batch.column(1)):
                n = len(s)
                number = sh.set_number(s) if n else None
                numbers.append(number)
                sizes.append(n)
                first = n and number not in met
                met.add(number)
                prefixes.append(_columns(s, frequent, seen)[: prefix_length(n, percent)].astype(np.int64) if first else None)
                bitmaps.append(parity_bitmap(s) if first else None)
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "class": pa.array(numbers, pa.int64()),
                    "n": pa.array(sizes, pa.int64()),
                    "prefix": pa.array(prefixes, pa.list_(pa.int64())),
                    "bits": pa.array(bitmaps, pa.list_(pa.int64())),
                }
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(described, f"doc_id {kind}, class long, n long, prefix array<long>, bits array<long>")


def _shared_columns(described: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(column, class, n, i, met, hub_0 ...) for the columns in which two classes or more meet; i
    is the column's place in the class's set. A class stays in a column only where its next
    smaller or larger one there is near enough in size to be linked. Only crowded columns have
    hubs: some by their number, and those with the least place i, in the column and in the
    class's band of sizes, as they have least of their own besides what the column's classes share."""
    entries = described.filter("prefix is not null").select("class", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("i", "column"))
    entries = entries.withColumn("band", F.floor(F.log("n") / math.log(100 / percent)).cast("int"))
    same, banded = Window.partitionBy("column"), Window.partitionBy("column", "band")
    rising = same.orderBy("band", "n")
    sized = entries.withColumns({"below": F.lag("n").over(rising), "above": F.lead("n").over(rising)})
    n = F.col("n").cast("long")
    near = sized.filter((F.col("below").cast("long") * 100 >= n * percent) | (n * 100 >= F.col("above").cast("long") * percent))
    masks = [(i << 60) - (1 << 63) if i >= 8 else i << 60 for i in range(0, 16, 16 // HUBS)]
    hubs = {f"hub_{i}": F.min(F.col("class").bitwiseXOR(F.lit(m))).over(same).bitwiseXOR(F.lit(m)) for i, m in enumerate(masks)}
    hubs |= {f"hub_{HUBS + i}": F.min(F.struct("i", "class")).over(w)["class"] for i, w in enumerate([same, banded])}
    met = near.withColumns({"met": F.count("*").over(same), "least": F.min("class").over(same), "most": F.max("class").over(same), **hubs})
    crowded = F.col("met") > LARGE_COLUMN
    kept = ["column", "class", "n", "i", "met"]
    return met.filter("least < most").select(*kept, *[F.when(crowded, F.col(f"hub_{h}")).alias(f"hub_{h}") for h in range(HUBS + 2)])


def _with_sets(docs: DataFrame, described: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, n, shingles) of the wanted classes, read again from one text of each."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, SLICE_BYTES):
            sets = [s for s in sh.shingle_sets(batch.column(0)) if len(s)]
            yield pa.record_batch(
                {
                    "class": pa.array([sh.set_number(s) for s in sets], pa.int64()),
                    "shingles": pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64())),
                }
            )

    members = restrict(described.filter("class is not null").select("class", "doc_id"), wanted, "class")
    one = stage(members.groupBy("class").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct(), "texts")
    listed = F.broadcast(one) if one.count() <= 1_000_000 else one
    texts = docs.join(listed.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    sets = texts.select("text").mapInArrow(whole, "class long, shingles array<long>")
    return restrict(sets, wanted, "class").dropDuplicates(["class"])


def _linked(docs: DataFrame, described: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of the written pairs (a, b) whose whole sets overlap enough. The pairs and what is
    written for them go again."""
    wanted = stage(pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct(), "wanted")
    sets = stage(_with_sets(docs, described, wanted), "sets")
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    overlap = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - overlap
    linked = stage(both.filter(overlap * 100 >= union * percent).select("a", "b"), "linked")
    unstage(pairs, wanted, sets)
    return linked


def _like_sizes(a: str, b: str, percent: int) -> Column:
    return (F.least(a, b) * F.lit(100)) >= (F.greatest(a, b) * F.lit(percent))


def _few_differ(a: str, b: str, required: Column) -> Column:
    """Whether the bitmaps of two sets leave room for the overlap that is required."""
    differing = sum((F.bit_count(F.col(f"bits_{a}")[i].bitwiseXOR(F.col(f"bits_{b}")[i])) for i in range(BITMAP_WORDS)), F.lit(0))
    return differing <= F.col(f"n_{a}") + F.col(f"n_{b}") - 2 * required


def _hub_pairs(described: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Each class of a crowded column with the column's hubs, where no bound speaks against a
    link; sets too large for their bitmaps must share a good part of the prefix as well. A pair
    that is passed over here comes up again in the full product."""
    crowded = shared.filter(F.col("met") > LARGE_COLUMN)
    hubs = F.explode(F.array_distinct(F.array(*[f"hub_{i}" for i in range(HUBS + 2)])))
    pairs = crowded.select(F.col("class").alias("a"), F.col("n").alias("n_a"), "i", hubs.alias("b")).filter("a <> b")
    pairs = pairs.groupBy("a", "n_a", "b").agg(F.count("*").alias("c"), F.min("i").alias("i"))
    described = described.filter("bits is not null").select("class", "n", "bits").dropDuplicates(["class"])
    of_a, of_b = described.select(F.col("class").alias("a"), F.col("bits").alias("bits_a")), described.toDF("b", "n_b", "bits_b")
    required = _required(F.col("n_a"), F.col("n_b"), percent)
    telling = (F.col("n_a") <= 64 * BITMAP_WORDS) | (F.col("c") * 10 >= F.col("n_a") * (100 - percent) / 100 * 3)
    close = pairs.filter(telling).join(of_b, "b").filter(_like_sizes("n_a", "n_b", percent) & (F.col("n_a") - F.col("i") >= required))
    close = close.join(of_a, "a").filter(_few_differ("a", "b", required)).select("a", "b", "c")
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("c"), "b"))
    nearest = close.withColumn("place", place).filter(F.col("place") <= NEAREST_HUBS)
    return stage(nearest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")


def _product_pairs(described: DataFrame, shared: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that meet in a column, whose bitmaps are near enough
    and whose sets have enough columns left from there on; then the columns that such a pair
    shares are counted and held against the bound."""
    rooted = shared.select("column", "class", "n", "i").join(
        roots.withColumnRenamed("node", "class"), "class", "left"
    ).withColumn("root", F.coalesce("root", "class"))
    open_columns = rooted.groupBy("column").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("column")
    still = stage(rooted.join(open_columns, "column", "left_semi").distinct(), "open")
    open_classes = still.select("class").distinct()
    bitmaps = described.filter("bits is not null").select("class", "bits").join(open_classes, "class", "left_semi").dropDuplicates(["class"])
    bare, still = still, stage(still.join(bitmaps, "class"), "open-bits")
    unstage(bare)

    def side(s: str) -> DataFrame:
        return still.select("column", F.col("class").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "i", "root", "bits")])

    required = _required(F.col("n_a"), F.col("n_b"), percent)
    # No column before the first common one is shared, so what follows must be enough there; at
    # later ones still less is left, so a pair that fails at the first fails everywhere.
    enough_left = F.least(F.col("n_a") - F.col("i_a"), F.col("n_b") - F.col("i_b")) >= required
    near = _like_sizes("n_a", "n_b", percent) & enough_left & _few_differ("a", "b", required)
    met = side("a").join(side("b"), "column").filter((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & near)
    close = stage(met.select("a", "b", "n_a", "n_b").distinct(), "close")
    # All that two of these share of their prefixes lies in open columns.
    of_a, of_b = still.select("column", F.col("class").alias("a")), still.select("column", F.col("class").alias("b"))
    counts = close.join(of_a, "a").join(of_b, ["column", "b"]).groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("c"))

    def beyond(n: str) -> Column:
        return F.ceil(F.col(n) * percent / F.lit(100.0) - F.lit(1e-9)) - 1

    at_most = F.col("c") + F.greatest(beyond("n_a"), beyond("n_b"))
    pairs = stage(counts.filter(at_most >= required).select("a", "b"), "pairs")
    unstage(still, shared, close)
    return pairs


def _between_roots(links: DataFrame, roots: DataFrame) -> DataFrame:
    """Links of classes as links of their roots, each once, with the roots' own stars."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    ends = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    return ends.distinct().unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, class, n, root) for every row: classes with one root are one component."""
    frequent = frequent_shingles(docs)
    described = stage(classes(docs, frequent, percent), "classes")
    shared = stage(_shared_columns(described, percent), "shared")
    first = _linked(docs, described, _hub_pairs(described, shared, percent), percent)
    roots = connected_components(first)
    rest = _linked(docs, described, _product_pairs(described, shared, roots, percent), percent)
    roots = connected_components(_between_roots(rest, roots))
    joined = described.select("doc_id", "class", "n").join(roots.withColumnRenamed("node", "class"), "class", "left")
    return joined.withColumn("root", F.coalesce("root", "class"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of `docs`."""
    grouped = _grouped(only(docs, doc_id=id_col, text=text_col), percent)
    named = grouped.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("members"))
    several = stage(named.filter("members > 1").drop("members"), "named")
    return grouped.join(several, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, all their columns, with one document of each group: that with the
    least doc_id. Documents without words stay. The texts are not shuffled: the rest is
    dropped by id; rows whose id is null or not unique are told apart by their class."""
    grouped = stage(_grouped(only(docs, doc_id=id_col, text=text_col), percent), "grouped")
    winners = stage(grouped.filter("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "class")).alias("w")), "winners")
    odd = stage(grouped.groupBy("doc_id").count().filter("count > 1 or doc_id is null").select(F.col("doc_id").alias("__odd")), "odd-ids")
    lost = grouped.join(winners, "root").filter(~(F.col("doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("class") == F.col("w.class"))))
    lost = stage(lost.select(F.col("doc_id").alias("__lost")).filter("__lost is not null").distinct(), "lost-ids")
    own = F.col(f"`{id_col}`")

    def side(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if frame.count() <= 1_000_000 else frame

    gone = side(stage(lost.select(F.col("__lost").alias("__gone")).unionByName(odd.filter("__odd is not null").select(F.col("__odd").alias("__gone"))).distinct(), "gone"))
    plain = docs.filter(own.isNotNull()).join(gone, own == F.col("__gone"), "left_anti")
    if not odd.limit(1).count():
        return plain
    place = docs.columns.index(text_col)

    def with_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place, SLICE_BYTES):
            numbers = pa.array([sh.set_number(s) if len(s) else None for s in sh.shingle_sets(batch.column(place))], pa.int64())
            yield batch.append_column("__class", numbers)

    doubtful = docs.join(side(odd), own.eqNullSafe(F.col("__odd")), "left_semi")
    classed = doubtful.mapInArrow(with_class, _with_field(docs))
    best = side(stage(winners.select(F.col("w.doc_id").alias("__id"), F.col("w.class").alias("__best")), "best"))
    won = classed.join(best, own.eqNullSafe(F.col("__id")) & (F.col("__class") == F.col("__best")), "left_semi")
    one = won.dropDuplicates([id_col, "__class"]).drop("__class")
    return plain.unionByName(one).unionByName(classed.filter("__class is null").drop("__class"))


def _with_field(docs: DataFrame) -> StructType:
    return StructType([*docs.schema.fields, StructField("__class", LongType())])
