"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from workload.queries import QUERIES

HEADLINE = (
    "status_intervals",
    "status_incremental",
    "status_priority_dedup",
    "trips_latest",
    "trips_enriched",
    "seed_patch",
    "telemetry_route",
    "trip_route",
    "silver_voi_trips",
    "silver_dott_events",
    "poppy_latest_snapshot",
    "page_hash_last",
    "page_hash_any",
    "landing_gaps_hourly",
    "bronze_to_gold_trips",
    "bronze_to_gold_status",
)


def run(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    run(QUERIES["trips_latest"], spark, sf_dir)  # warm up the session and the file listing
    times = {}
    for name in names:
        times[name] = round(min(run(QUERIES[name], spark, sf_dir) for _ in range(2)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, best of two runs each, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
