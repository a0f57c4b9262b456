"""Small helpers that the operators share."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levyscan.sources.staging import stage

#: Tables up to this many rows of a few numbers each (about 16 MB) may be broadcast.
BROADCAST_KEYS = 1_000_000
#: The characters that end a word: blank, tab, line feed, vertical tab, form feed, return.
WORD_BREAKS = "\\x20\\x09-\\x0D"
WORD_PATTERN = f"[^{WORD_BREAKS}]+"
#: Documents that cross to Python at once. Some kilobytes each, they make batches of a few MB on
#: both sides, whatever the session's own, larger setting.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(spark: SparkSession) -> None:
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns alone, under the names that the operator uses. Whatever other
    columns the input has, and whatever their names, they are not read."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def shares(total: int, n: int) -> Iterator[float]:
    """Shares of a hash's range to look for the `n` least hashes of `total` rows in: one that
    holds about twice as many, larger ones should that be too few, and at last all of it. So a
    bounded sample moves a number of rows that does not grow with the input's partitions."""
    share = (2 * n + 1_000) / max(total, 1)
    while share < 1:
        yield share
        share *= 4
    yield 1.0


def in_share(hashed: Column, share: float) -> Column:
    """Whether a 64-bit hash lies in the lowest `share` of its range."""
    return hashed < F.lit(int(share * (1 << 64)) - (1 << 63)) if share < 1 else hashed.isNotNull()


def restrict(df: DataFrame, keys: DataFrame, on: str, limit: int = BROADCAST_KEYS) -> DataFrame:
    """Rows whose key is listed. A list is broadcast once its count proves to be small; a
    longer one is shuffled with the rows."""
    listed = F.broadcast(keys) if keys.count() <= limit else keys
    return df.join(listed, on, "left_semi")


def crc_remainder(column: str, modulus: int):
    """crc32 of a number's decimal text, modulo `modulus`; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def unstage(*frames: DataFrame) -> None:
    """Remove the files of written frames whose reading has ended."""
    for frame in frames:
        folders = {f.rsplit("/", 1)[0] for f in frame.inputFiles()}
        for folder in folders:
            path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a text column has about `most` bytes in each; one long text
    stays whole."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


__all__ = ["BROADCAST_KEYS", "WORD_BREAKS", "WORD_PATTERN", "crc_remainder", "only", "restrict", "slices", "stage", "table", "unstage"]
