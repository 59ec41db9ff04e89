"""Benchmark the headline queries.

Runs each query end to end into Spark's ``noop`` sink (full execution, no
collect) at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``. Each query is timed ``$BENCH_REPEAT`` times (default 3;
nothing is cached between runs, every run re-reads and recomputes) and the best
run is reported, to damp machine noise, with the median beside it. Prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "median": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tramline.plans.queries import REGISTRY  # noqa: E402
from tramline.session import build_session  # noqa: E402

HEADLINE = [
    "stg_vehicle_positions",
    "stg_weather",
    "stg_trip_updates",
    "stg_alerts",
    "route_performance",
    "hourly_service",
    "alert_impact",
    "fleet_curve",
    "alert_upsert",
    "dq_suite",
    "csv_bulk",
    "collapse_duplicates",
    "stream_alert_fold",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        master=f"local[{cpus}]", app_name="tramline-bench", shuffle_partitions=int(cpus),
        checkpoint_dir=tempfile.mkdtemp(prefix="tramline-bench-"),
        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    # Warm-up, not timed: the same queries once on the smallest tables, so JIT
    # compilation and generated-code compilation are not charged to whichever
    # query happens to run first at the measured scale.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            REGISTRY[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    times: dict[str, float] = {}
    medians: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(min(runs), 3)
        medians[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "median": medians,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
