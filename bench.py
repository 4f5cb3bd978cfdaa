"""Time the headline queries and print one JSON line.

Each query is run once to warm up and then BENCH_RUNS times; the median wall
time of writing its whole result to Spark's ``noop`` sink is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from queries import QUERIES  # noqa: E402

HEADLINE = [
    "gold_monthly",
    "gold_monthly_from_silver",
    "gold_by_month",
    "silver_yellow",
    "silver_hvfhv",
    "dedup_latest",
    "drop_exact_duplicates",
    "upsert_customers",
    "scd2_apply",
    "dataset_fingerprint_lineitem",
    "row_hash",
    "mask_all",
    "standard_clean",
    "cast_via_string",
    "quality_report",
    "profile",
    "mean_of_group_totals",
    "monthly_mean",
    "hourly_mean_all",
    "hourly_passengers",
    "clustered_roundtrip",
    "partition_upsert",
    "stream_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
    line = {
        "metric": "total of median seconds per headline query",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "spark": spark.version,
        "cpus": int(cpus),
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
