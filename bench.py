"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads, ``BENCH_RUNS`` the timed runs per query (their
median counts, after one run to warm up). Results go to Spark's no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tasklens.plans import QUERIES
from tasklens.session import build_session

HEADLINE = (
    "task_latest_state",
    "carry_task_name",
    "join_task_meta",
    "quarantine_poison",
    "explode_envelopes",
    "dedupe_events",
    "unify_sources",
    "task_runtime_stats",
    "failure_breakdown",
    "retry_chains",
    "worker_load",
    "state_drift",
    "circuit_break",
    "retry_summary",
    "retry_plan",
    "retain_latest_n",
    "queue_depths",
    "merge_registry",
    "registry_diff",
    "scan_definitions",
    "scrub_text",
    "coerce_kwargs",
    "task_tree",
    "stream_counts",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for key in chosen:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[key] = round(statistics.median(times[1:]), 3)
    line = {
        "metric": "headline queries, total of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
