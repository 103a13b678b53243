"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Each query is run once to warm up and then timed, all rows evaluated.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.session import build_session
from workload.queries import QUERIES

HEADLINE = [
    "raw_json_scan", "validate_events", "silver_dedup_latest", "silver_events",
    "silver_incremental", "mart_dau", "mart_revenue", "mart_event_mix", "mart_funnel",
    "mart_funnel_join", "mart_incremental", "scd2_full_build", "scd2_incremental_apply",
    "scd2_replay", "dq_not_null", "dq_unique", "dq_accepted_values", "pipeline_marts",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
