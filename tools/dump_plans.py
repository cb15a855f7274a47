"""Write the executed physical plans of the headline queries to PLANS.md.

    python tools/dump_plans.py /root/testdata/sf0.01 > PLANS.md

Each query is run once (collect) so the plan shown is the final adaptive
plan; the tree is followed by the scan lines that show pruning/pushdown.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["ohlcv_bars_1m", "sliding_counts", "sessions", "upsert_by_key", "recent_trades",
         "pruned_read", "version_as_of", "snapshot_diff", "late_rows", "reconcile_bars"]


def condensed(plan: str) -> str:
    keep = []
    plan = plan.split("+- == Initial Plan ==")[0]
    for line in plan.splitlines():
        s = re.sub(r"#\d+L?", "", line)
        s = re.sub(r", \[plan_id=\d+\]", "", s)
        s = re.sub(r"file:/\S+", "<path>", s)
        if len(s) > 160:
            s = s[:157] + "..."
        keep.append(s)
    return "\n".join(keep)


def main() -> None:
    from tidemark.registry import QUERIES
    from tidemark.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=16, extra={"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-plans-"))
    print("# Executed physical plans (final adaptive plans, sf0.01, 16 shuffle partitions)\n")
    print("Generated by `tools/dump_plans.py`. Expression ids, plan ids and paths are stripped.\n")
    for name in NAMES:
        df = QUERIES[name](spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n```\n{condensed(plan)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
