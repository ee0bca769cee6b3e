"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR, BENCH_CPUS and BENCH_REPEATS set the tables, the cores and the
number of timed runs per query (after one untimed run); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.compare import local_session  # noqa: E402
from checks.registry import _DONE, queries  # noqa: E402

HEADLINE = (
    "dwd_events",
    "dwd_items",
    "dedupe_lineitem",
    "flatten_events",
    "flatten_items",
    "session_summary",
    "gap_sessions",
    "daily_kpi",
    "summary",
    "funnel",
    "cohort_retention",
    "channel_summary",
    "product_summary",
    "user_value",
    "daily_anomaly",
    "quality_report",
    "landing_manifest",
    "extract_and_build",
    "contract_export",
    "incremental_cohorts",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cores, cores)
    registered, took = queries(), {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats + 1):
            _DONE.clear()  # builds are timed, not looked up
            began = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        took[name] = round(statistics.median(runs[1:]), 3)
    total = round(sum(took.values()), 3)
    line = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": took, "sf": Path(folder).name}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
