"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1)
with local[$BENCH_CPUS]; prints one JSON line.

Each query is forced with a ``noop`` write (full computation, nothing pulled
to the driver). A warm-up pass on sf0.001 runs first so JVM start-up and
code generation caches are not billed to the first query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "state_changes",            # flagship: frames -> typed state changes
    "state_changes_from_text",  # same through JSON text + decode
    "rejects",
    "latest_states",
    "batch_by_count",
    "batch_by_wait",
    "rate_events",
    "rate_samples",
    "bucket_quantile",
    "alert",
    "ingest_counters",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from stategrid.session import get_session
    from stategrid.plans.registry import QUERIES
    spark = get_session(f"local[{cpus}]", app="stategrid-bench",
                        shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for name in HEADLINE:
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    rows = spark.read.parquet(os.path.join(sf_dir, "events.parquet")).count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else None,
        "events_rows": rows, "cpus": cpus,
        "flagship_rows_per_sec": round(rows / times["state_changes"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
