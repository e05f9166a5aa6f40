"""Write the executed physical plans of the headline queries to docs/plans/.

usage: python tools/explain.py [sf_dir]
Runs each query once (noop write) so the adaptive plan is final, then saves
``explain("formatted")`` and prints a one-line summary per query.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["state_changes", "state_changes_from_text", "latest_states", "batch_by_count",
         "batch_by_wait", "rate_events", "rate_samples", "bucket_quantile", "alert",
         "vector_ratio", "time_range"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from stategrid.session import get_session
    from stategrid.plans.registry import QUERIES
    spark = get_session("local[8]", shuffle_partitions=8)
    out_dir = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    for name in NAMES:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        # formatted explain of the final adaptive plan
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(text)
        count = lambda pat: len(re.findall(pat, plan))
        print(f"{name:26s} exchanges={count(r'Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning'):2d} "
              f"broadcasts={count(r'BroadcastExchange'):2d} reused={count(r'ReusedExchange'):2d} "
              f"scans={count(r'FileScan parquet'):2d} smj={count(r'SortMergeJoin'):2d} "
              f"bhj={count(r'BroadcastHashJoin'):2d} python={count(r'FlatMapGroupsInPandas|ArrowEvalPython'):2d}")


if __name__ == "__main__":
    main()
