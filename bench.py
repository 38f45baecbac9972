"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local threads (8).
Each query runs once cold and then warm; the warm time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from suite.queries import QUERIES  # noqa: E402

HEADLINE = [
    "sessions_paired",
    "bookings_paired",
    "fct_sessions",
    "fct_bookings",
    "rebooking_rate",
    "rebooking_orders",
    "booking_reliability",
    "booking_intent",
    "incremental_append",
    "late_events_frozen",
    "dedup_keep_first",
    "normalise_events",
    "dim_users",
    "scd2_snapshot",
    "dq_relationships",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # Do not look up the Python line of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - begin, 3)

    cold = {name: run(name) for name in names}
    warm = {name: min(run(name) for _ in range(2)) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
