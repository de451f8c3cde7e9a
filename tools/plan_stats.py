"""Per registered query: node counts in the final (adaptive) physical plan.

Runs each query once, then reads ``explain()`` of the executed plan and counts
shuffle exchanges, broadcasts, windows, file scans and joins.  Prints a
Markdown table.  Usage: python tools/plan_stats.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradeflow.plans.inspect import explain_text  # noqa: E402
from tradeflow.queries import QUERIES  # noqa: E402
from tradeflow.session import make_session  # noqa: E402

NODES = {
    "shuffles": r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition|ReusedExchange",
    "broadcasts": r"BroadcastExchange",
    "windows": r"\bWindow\b",
    "scans": r"\bScan parquet|\bFileScan parquet",
    "joins": r"SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin",
}


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = make_session("plan-stats", master="local[4]", **{"spark.sql.shuffle.partitions": "8"})
    print("| query | " + " | ".join(NODES) + " |")
    print("| --- |" + " --- |" * len(NODES))
    for key, q in QUERIES.items():
        df = q(spark, sf)
        df.collect()
        text = explain_text(df, "simple")
        if "== Final Plan ==" in text:  # adaptive plan: count the plan that ran
            text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
        counts = [len(re.findall(p, text)) for p in NODES.values()]
        print(f"| {key} | " + " | ".join(str(c) for c in counts) + " |")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
