"""Layers that readers see whole or not at all.

A layer is a folder of tables. A job writes all of them into a fresh folder, one per version,
and then publishes the version in one final step: an empty file named after it. Readers take
the newest published version. A job that fails leaves its unpublished folder behind and the
older version as it was; the next job does not look at it. Creating one file is atomic on
every file system, and no step renames or overwrites what readers may hold open.
"""

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from levyscan.sources.staging import Jobs

_MARKS = "_published"


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _layer(base: str, layer: str) -> str:
    return f"{base.rstrip('/')}/{layer}"


def new_version(base: str, layer: str) -> str:
    """The folder of a version to come. Names rise with time."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{_layer(base, layer)}/{stamp}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, folder: str) -> str:
    """Make a written version the one that readers take."""
    layer, version = folder.rsplit("/", 1)
    mark, files = _path(spark, f"{layer}/{_MARKS}/{version}")
    files.create(mark, False).close()
    return folder


def versions(spark: SparkSession, base: str, layer: str) -> list[str]:
    """Published versions, the oldest first."""
    marks, files = _path(spark, f"{_layer(base, layer)}/{_MARKS}")
    if not files.exists(marks):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(marks))


def current(spark: SparkSession, base: str, layer: str) -> str:
    """The folder of the newest published version."""
    found = versions(spark, base, layer)
    if not found:
        raise FileNotFoundError(f"no version of {layer} is published under {base}")
    return f"{_layer(base, layer)}/{found[-1]}"


def _write_counted(df: DataFrame, path: str, name: str) -> tuple[str, int]:
    """Write a table and count the rows that are in its files. The count reads file footers
    alone. (`observe` would count while writing, but once it is used no Spark ML model can
    score in that session any more: the session can then no longer be serialised.)"""
    df.write.parquet(path)
    return name, df.sparkSession.read.schema(df.schema).parquet(path).count()


def write_layer(spark: SparkSession, base: str, layer: str, tables: dict[str, DataFrame], also: Callable[[str], None] | None = None) -> str:
    """Write the tables side by side, let `also` add files of its own to the folder, publish.
    The table `metrics` (table, rows) tells what was written; no table is scanned again for it."""
    folder = new_version(base, layer)
    with Jobs(spark) as jobs:
        written = [jobs.start(lambda df=df, name=name: _write_counted(df, f"{folder}/{name}", name)) for name, df in tables.items()]
        counts = [job.result() for job in written]
    spark.createDataFrame(counts, "table string, rows long").coalesce(1).write.parquet(f"{folder}/metrics")
    if also is not None:
        also(folder)
    return publish(spark, folder)


def read_layer(spark: SparkSession, base: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{current(spark, base, layer)}/{table}")


def retire(spark: SparkSession, base: str, layer: str, keep: int = 2) -> list[str]:
    """Remove published versions but the newest `keep`: first their marks, then their files."""
    old = versions(spark, base, layer)[: -keep or None]
    for version in old:
        for name in (f"{_MARKS}/{version}", version):
            path, files = _path(spark, f"{_layer(base, layer)}/{name}")
            files.delete(path, True)
    return old
