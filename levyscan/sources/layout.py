"""Tables laid out by a key, so that joins on it need no exchange.

Tables with the same key and number of buckets share one layout: their rows of one key lie in
the same bucket. A table is written once into the shared folder, in one exchange; every later
join or aggregate on the key reads it bucket by bucket. The number of buckets is the session's
number of shuffle partitions, so that a table that is not laid out can join at the cost of its
own exchange alone.
"""

import uuid

from pyspark.sql import DataFrame

from levyscan.sources.staging import forget_with_run, new_path


def laid_out(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write the frame in buckets of `key` and go on from the written table."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"levyscan_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key)
    dealt.write.format("parquet").bucketBy(buckets, key).option("path", new_path(spark, name)).saveAsTable(table)
    forget_with_run(spark, table)
    return spark.table(table)
