"""Written intermediate tables.

A few operators need one physical layout to be read more than once. They write it as
Parquet under the folder named by ``spark.checkpoint.dir``, which every executor can
reach, so a lost executor costs a re-read and never changes the result. Where that setting is
missing, the folder is ``_staged`` under the session's warehouse. Each run of an application
has a subfolder of its own, which `drop_staged` removes.
"""

import atexit
import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_seen: set[str] = set()
_tables: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(f"{root}/checkpoints")
    return root.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """This application's own folder; what it holds goes when a local session's program ends."""
    app = spark.sparkContext.applicationId
    if app not in _seen:
        _seen.add(app)
        if spark.sparkContext.master.startswith("local["):
            atexit.register(_drop_quietly, spark)
    return f"{shared_folder(spark)}/levyscan/{app}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the frame once and go on from the written table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Jobs:
    """Jobs side by side, so that one's last tasks do not leave the cluster idle. A task is
    started as soon as it is named; it may wait for the result of one started before it."""

    def __init__(self, spark: SparkSession):
        self._spark = spark

    def __enter__(self) -> "Jobs":
        self._pool = ThreadPoolExecutor(32)
        return self

    def __exit__(self, *error) -> None:
        self._pool.shutdown(cancel_futures=True)

    def start(self, task: Callable[[], DataFrame]) -> Future:
        return self._pool.submit(inheritable_thread_target(self._spark)(task))


def forget_with_run(spark: SparkSession, table: str) -> None:
    """Take the catalog entry out again when this run's files go."""
    _tables.setdefault(spark.sparkContext.applicationId, []).append(table)


def drop_staged(spark: SparkSession) -> None:
    """Remove all that this run has written. Frames that read it can be used no longer."""
    for table in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _drop_quietly(spark: SparkSession) -> None:
    if spark._jsc is not None and spark.sparkContext._jsc is not None:
        drop_staged(spark)
