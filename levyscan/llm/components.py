"""Connected components of a link table, in Spark."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyscan.llm.common import stage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that has a link; root is the least node it reaches.

    Each round takes the least root among a node and its neighbours and then the root of
    that root, so that stars end in two rounds and chains in about the logarithm of their
    length. Rounds are written tables: nothing is held by one executor or the driver.
    Self-links and repeated links do no harm; an empty table gives an empty table.
    """
    one_way = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    other_way = links.select(F.col(b).alias("node"), F.col(a).alias("other"))
    both = stage(one_way.unionByName(other_way).distinct(), "links")
    roots = stage(
        both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")).withColumn("before", F.col("node")),
        "roots",
    )
    while roots.filter("root <> before").limit(1).count():
        near = (
            both.join(roots.select(F.col("node").alias("other"), F.col("root").alias("theirs")), "other")
            .groupBy("node")
            .agg(F.min("theirs").alias("theirs"))
        )
        least = roots.join(near, "node").select("node", F.least("root", "theirs").alias("step"), F.col("root").alias("before"))
        of_root = roots.select(F.col("node").alias("step"), F.col("root").alias("beyond"))
        roots = stage(
            least.join(of_root, "step", "left").select(
                "node", F.least("step", F.coalesce("beyond", "step")).alias("root"), "before"
            ),
            "roots",
        )
    return roots.select("node", "root")
