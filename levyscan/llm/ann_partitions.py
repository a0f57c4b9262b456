"""Approximate nearest neighbours by learned partitions.

On a bounded sample a graph of nearest neighbours is built and cut into balanced partitions:
seeds are spread, then vectors move to the partition that holds most of their neighbours, as
long as it has room. A small classifier (softmax regression on the vector) learns the
partition from the vector. It places every row of the table, and it routes a query to its
most probable partitions, in which all rows are measured exactly. How many partitions a query
visits is set on the sample: the fewest that reach `AIM` of the true neighbours there, and more
for a query whose partitions hold fewer than k other rows between them.

Rows and queries are packed into blocks by partition and joined block by block; a large
partition is dealt into slices of about `ROWS_PER_SLICE` rows, each of which all its queries
visit, a join task sees one pair of blocks at a time, and each keeps a query's k best only.

Defined results: vectors that are null, zero, of another length than most of the sample, or that hold a
null or a value that is not finite take no part, neither as queries nor as candidates; a
query's own row is no candidate, other rows with its id or its vector are (rows are numbered as
the index is written); rows that share a query's id are queries of their own, each with its k
places; ties go to the smaller id; with k candidates or fewer all there are are returned;
distances beyond the largest double are infinite; an empty table gives an empty table; other
columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from levyscan.llm.common import in_share, only, shares, stage

SAMPLE_ROWS = 8_000
PARTITIONS = 24
GRAPH_K = 16
AIM = 0.985
TUNING_QUERIES = 400
K = 10
BLOCK_ROWS = 2048
ROWS_PER_SLICE = 1_000_000  # of one partition, in one group of the join
SLACK = 1.15  # a partition's room, against an equal share


def valid(vector: Column) -> Column:
    doubles = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(doubles, lambda x: x != 0), F.lit(False))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def neighbour_graph(x: np.ndarray, k: int = GRAPH_K) -> np.ndarray:
    """The k nearest rows of each row, itself left out."""
    k = min(k, len(x) - 1)
    out = []
    for start in range(0, len(x), 512):
        d = _distances(x[start : start + 512], x)
        d[np.arange(len(d)), start + np.arange(len(d))] = np.inf
        out.append(np.argpartition(d, k - 1, axis=1)[:, :k] if k else np.empty((len(d), 0), np.int64))
    return np.concatenate(out)


def balanced_partitions(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """A partition for each row: few edges are cut, none holds more than its room."""
    n = len(x)
    room = int(np.ceil(n / parts * SLACK))
    draw = np.random.default_rng(3)
    centres = x[draw.choice(n, parts, replace=False)]
    for _ in range(8):
        near = _distances(x, centres).argmin(1)
        for p in range(parts):
            if (near == p).any():
                centres[p] = x[near == p].mean(0)
    wish = _distances(x, centres)
    label = np.full(n, -1)
    held = np.zeros(parts, np.int64)
    for i in np.argsort(wish.min(1)):
        p = next(p for p in np.argsort(wish[i]) if held[p] < room)
        label[i], held[p] = p, held[p] + 1
    for _ in range(rounds):
        moved = 0
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (np.repeat(np.arange(n), graph.shape[1]), label[graph].ravel()), 1)
        gain = votes.max(1) - votes[np.arange(n), label]
        for i in np.argsort(-gain):
            if gain[i] <= 0:
                break
            p = int(votes[i].argmax())
            if held[p] < room:
                held[label[i]] -= 1
                held[p] += 1
                label[i] = p
                moved += 1
        if not moved:
            break
    return label


def fit_classifier(x: np.ndarray, label: np.ndarray, parts: int, rounds: int = 300, shrink: float = 1e-4) -> np.ndarray:
    """Softmax regression by gradient steps with momentum; the last row is the bias."""
    x1 = np.column_stack([x / np.sqrt((x * x).sum(1).mean()), np.ones(len(x))])
    w = np.zeros((x1.shape[1], parts))
    speed = np.zeros_like(w)
    target = np.eye(parts)[label]
    for _ in range(rounds):
        z = x1 @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed - 4.0 * (x1.T @ (p - target) / len(x) + shrink * w)
        w += speed
    w[:-1] /= np.sqrt((x * x).sum(1).mean())
    return w


class Router:
    """The classifier and how many partitions a query visits."""

    def __init__(self, weights: np.ndarray, visits: int):
        self.weights, self.visits = weights, visits

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Partitions of each row, the most probable first."""
        return np.argsort(-(x @ self.weights[:-1] + self.weights[-1]), axis=1, kind="stable")


def train(vectors: DataFrame, sample_rows: int = SAMPLE_ROWS, parts: int = PARTITIONS, aim: float = AIM, k: int = K) -> tuple[Router, int] | None:
    """A router from at most `sample_rows` valid rows (id, vector), those with the least
    hashes, and the vectors' length. None without a valid row."""
    hashed = vectors.filter(valid(F.col("vector"))).withColumn("h", F.xxhash64(F.lit("ann"), "id"))
    rows = []
    for share in shares(vectors.count(), sample_rows):
        rows = hashed.filter(in_share(F.col("h"), share)).orderBy("h", "id").limit(sample_rows).select("vector").collect()
        if len(rows) == sample_rows:
            break
    if not rows:
        return None
    sizes = [len(r.vector) for r in rows]
    length = max(sorted(set(sizes)), key=sizes.count)
    x = np.array([r.vector for r in rows if len(r.vector) == length], dtype=np.float64)
    unit = 2.0 ** (np.frexp(np.abs(x).max())[1] - 1)  # squares of very large components overflow
    x = x / unit
    parts = max(1, min(parts, len(x) // 64))
    if parts == 1:
        return Router(np.zeros((length + 1, 1)), 1), length
    graph = neighbour_graph(x)
    weights = fit_classifier(x, balanced_partitions(x, graph, parts), parts)
    ranked = Router(weights, parts).ranked(x)
    home = ranked[:, 0]
    some = np.random.default_rng(9).permutation(len(x))[:TUNING_QUERIES]
    true = neighbour_graph(x, k)[some]
    place = np.argsort(ranked[some], axis=1)  # at which visit each partition comes
    visit = np.take_along_axis(place, home[true], axis=1)
    weights[:-1] /= unit
    return Router(weights, next(v for v in range(1, parts + 1) if (visit < v).mean() >= aim)), length


_SIDE = ("ids", "numbers", "asks", "vectors")
_BLOCK = "part int, ids binary, numbers binary, asks binary, n_asks int, vectors binary"


def _batch(part: int, ids: np.ndarray, numbers: np.ndarray, asks: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "part": pa.array([part], pa.int32()),
            "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
            "numbers": pa.array([numbers.astype(np.int64).tobytes()], pa.binary()),
            "asks": pa.array([asks.astype(np.int8).tobytes()], pa.binary()),
            "n_asks": pa.array([int(asks.sum())], pa.int32()),
            "vectors": pa.array([x.astype(np.float64).tobytes()], pa.binary()),
        }
    )


def _in_blocks(found: Iterator[tuple], block_rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of (parts of each row, ids, numbers, asks, vectors): a row goes to each of its parts."""
    held: dict[int, list] = {}
    sizes: dict[int, int] = {}

    def block(part: int) -> pa.RecordBatch:
        sizes.pop(part)
        return _batch(part, *(np.concatenate(c) for c in zip(*held.pop(part))))

    for goes, *columns in found:
        for part in np.unique(goes[goes >= 0]).tolist():
            mine = np.flatnonzero((goes == part).any(1))
            held.setdefault(part, []).append(tuple(c[mine] for c in columns))
            sizes[part] = sizes.get(part, 0) + len(mine)
        for part in [p for p, n in sizes.items() if n >= block_rows]:
            yield block(part)
    for part in list(held):
        yield block(part)


def _index(rows: DataFrame, router: Router, length: int, block_rows: int) -> DataFrame:
    """Rows (id, number, asks, vector) in blocks, each row in its most probable partition."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in batches:
                if batch.num_rows:
                    x = np.asarray(batch.column(3).flatten(), dtype=np.float64).reshape(-1, length)
                    columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
                    yield router.ranked(x)[:, :1], *columns, x

        yield from _in_blocks(found(), block_rows)

    return rows.select("id", "number", "asks", "vector").mapInArrow(blocks, _BLOCK)


def _opened(batch: pa.RecordBatch, i: int, length: int) -> tuple[np.ndarray, ...]:
    """(ids, numbers, asks, vectors) of a block."""
    types = {"ids": np.int64, "numbers": np.int64, "asks": np.int8, "vectors": np.float64}
    ids, numbers, asks, x = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=t) for c, t in types.items())
    return ids, numbers, asks, x.reshape(-1, length)


def _queries(index: DataFrame, router: Router, length: int, sizes: np.ndarray, k: int, block_rows: int) -> DataFrame:
    """The index's rows that ask, in blocks, once for each partition that they visit: the most
    probable ones, as many as the router says and until they hold k rows beside the query's own."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, numbers, asks, x = _opened(batch, i, length)
                    mine = asks == 1
                    goes = router.ranked(x[mine])
                    before = np.cumsum(sizes[goes], axis=1) - sizes[goes]
                    goes = np.where((np.arange(goes.shape[1]) < router.visits) | (before < k + 1), goes, -1)
                    yield goes, ids[mine], numbers[mine], asks[mine], x[mine]

        yield from _in_blocks(found(), block_rows)

    return index.filter("n_asks > 0").mapInArrow(blocks, _BLOCK)


def _exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    gap = rows - query
    with np.errstate(over="ignore", invalid="ignore"):
        d = np.sqrt((gap**2).sum(1))
        far = ~np.isfinite(d)
        if far.any():  # the squares overflow, the distance may not
            most = np.abs(gap[far]).max(1)
            d[far] = np.where(np.isfinite(most), most * np.sqrt(((gap[far] / most[:, None]) ** 2).sum(1)), np.inf)
    return d


def _block_best(queries: tuple[np.ndarray, ...], rows: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """(query's number and id, row's number and id, distance) of each query's k nearest rows in
    a block, its own row left out."""
    q_ids, q_numbers, _, q = queries
    v_ids, v_numbers, _, v = rows
    with np.errstate(over="ignore", invalid="ignore"):
        near = _distances(q, v)
        scale = (q * q).sum(1) + (v * v).sum(1).max()
    near[np.isnan(near)] = 0  # of overflows: measured exactly below
    own = q_numbers[:, None] == v_numbers[None]
    near[own] = np.inf
    out = []
    for i in range(len(q)):
        mine = np.flatnonzero(~own[i])
        if len(v) > k and np.isfinite(scale[i]):
            limit = np.partition(near[i], k - 1)[k - 1] + 1e-9 * scale[i]
            mine = mine[near[i][mine] <= limit]
        d = _exact(v[mine], q[i])
        best = np.lexsort((v_numbers[mine], v_ids[mine], d))[:k]
        same = np.ones(len(best), np.int64)
        out.append((same * q_numbers[i], same * q_ids[i], v_numbers[mine[best]], v_ids[mine[best]], d[best]))
    return tuple(np.concatenate(c) for c in zip(*out))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    sample_rows: int = SAMPLE_ROWS,
    parts: int = PARTITIONS,
    aim: float = AIM,
    block_rows: int = BLOCK_ROWS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """query_id, rank, vec_id, score for each row for which `is_query` (an expression over
    `id`) holds."""
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    rows = only(vectors, id=id_col, vector=vector_col).filter("id is not null")
    fitted = train(rows, sample_rows, parts, aim, k)
    if fitted is None:
        return spark.createDataFrame([], schema)
    router, length = fitted
    rows = rows.filter(valid(F.col("vector")) & (F.size("vector") == length)).select(
        F.col("id").cast("long").alias("id"),
        F.monotonically_increasing_id().alias("number"),
        F.coalesce(is_query, F.lit(False)).cast("int").alias("asks"),
        F.col("vector").cast("array<double>").alias("vector"),
    )
    # Numbers hold from here on: queries and candidates are both read from what is written.
    index = stage(_index(rows, router, length, block_rows), "ann-rows")
    sizes = np.zeros(len(router.weights[0]), np.int64)
    for r in index.groupBy("part").agg(F.sum(F.length("asks")).alias("n")).collect():  # a row a partition
        sizes[r.part] = r.n
    asked = stage(_queries(index, router, length, sizes, k, block_rows // 4), "ann-queries")
    # A partition holds a fixed share of all rows: slices keep the join's groups at one size.
    n_slices = 1 + vectors.count() // (len(router.weights[0]) * rows_per_slice)
    index = index.withColumn("slice", F.pmod(F.xxhash64("ids"), F.lit(n_slices)))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_slices - 1).cast("long"))).alias("slice")
    mine = asked.select("part", *[F.col(c).alias(f"q_{c}") for c in _SIDE], each)
    pairs = mine.join(index.select("part", "slice", *_SIDE), ["part", "slice"])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            side = {c: batch.column(f"q_{c}") for c in _SIDE}
            asking = pa.RecordBatch.from_pydict(side)
            for i in range(batch.num_rows):
                best = _block_best(_opened(asking, i, length), _opened(batch, i, length), k)
                yield pa.record_batch(dict(zip(("query", "query_id", "number", "vec_id", "score"), map(pa.array, best))))

    found = pairs.select(*[f"q_{c}" for c in _SIDE], *_SIDE).mapInArrow(measured, "query long, query_id long, number long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id", "number"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
