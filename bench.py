"""Seconds per query on the generated tables; prints one JSON line.

    BENCH_SF_DIR  folder of the tables   (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores to use     (default 8)

A query is timed from building its frame to having computed every row and
column of it; nothing is sent to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cestero.catalog.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# What starts the JVM and compiles first should not weigh on one query.
WARM_UP = ("executive_summary", "rfm_segmentation", "association_rules")


def seconds(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in WARM_UP:
        seconds(spark, name)
    timings = {name: round(seconds(spark, name), 3) for name in QUERIES}
    spark.stop()
    result = {
        "metric": "total seconds over all registered queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
