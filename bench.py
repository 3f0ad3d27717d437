"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}

Every query is fully evaluated through the ``noop`` sink (all rows computed,
nothing collected). Each is run ``$BENCH_RUNS`` times (default 2) after one
warm-up of the JVM; the best time is reported.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "kpis_large",
    "kpis_large_by_dropoff",
    "joined_trips",
    "daily_kpis_completed_by_pickup",
    "daily_kpis_completed_by_dropoff",
    "trips_replay",
    "trips_merge",
    "normalize_start_events",
    "valid_end_fields",
    "line_rejects",
    "run_report",
    "write_outputs",
    "trips_replay_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else sf_dir

    from tripcraft.plans.queries import QUERIES
    from tripcraft.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="tripcraft-bench",
                          shuffle_partitions=int(cpus) * 2)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("daily_kpis_all")  # warm-up: JVM, code generation caches, file listing
    times = {}
    for name in HEADLINE:
        times[name] = round(min(run(name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
