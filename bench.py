"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from levyscan.checks import QUERIES  # noqa: E402
from levyscan.checks.registry import Inputs  # noqa: E402
from levyscan.operators.ordering import top_suspicious  # noqa: E402
from levyscan.plans.gold import gold_vendor_risk  # noqa: E402

def headline(spark: SparkSession, base: str) -> dict:
    """Each query from the layer it reads in use: bronze, silver, name scores and curves from
    the trade tables, gold and the top-50 report from the silver table as written."""
    silver = Inputs(spark, base).silver_table
    return {
        "bronze": lambda: QUERIES["pl1_bronze_orders"](spark, base),
        "silver": lambda: QUERIES["pl3_silver"](spark, base),
        "fuzzy_match": lambda: QUERIES["ru6_name_similarity"](spark, base),
        "gold_vendor_risk": lambda: gold_vendor_risk(silver),
        "suspicious_top50": lambda: top_suspicious(silver),
        "roc_auc": lambda: QUERIES["ml10_roc_auc"](spark, base),
    }


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("levyscan-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for label, build in headline(spark, base).items():
        runs = []
        for _ in range(repeats + 1):
            started = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[label] = round(statistics.median(runs[1:]), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(base.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
