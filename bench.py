"""Headline-query benchmark.

Runs the main queries at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full with the ``noop`` sink (all rows computed,
nothing collected); queries that write tables (versions, streams) include
their writes.  A few untimed warm-up queries run first on a smaller scale.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ohlcv_bars_1m", "ohlcv_bars_1h", "symbol_summary", "side_summary", "recent_trades",
    "buy_pressure_all", "window_stats", "sliding_counts", "moving_average", "sessions",
    "upsert_by_key", "upsert_orders_by_customer", "parse_trades_lenient", "reconcile_bars",
    "running_summary", "late_rows", "current_table", "version_as_of", "snapshot_diff",
    "pruned_read", "tumbling_bars_stream", "upsert_bars_stream",
]

WARM_DIR = "/root/testdata/sf0.01"
WARM_UP = ["ohlcv_bars_1m", "sessions", "upsert_by_key", "parse_trades_lenient", "tumbling_bars_stream"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tidemark.registry import QUERIES
    from tidemark.session import get_session

    spark = get_session(f"local[{cpus}]", app="tidemark-bench",
                        shuffle_partitions=int(cpus) * 2,
                        extra={"spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-bench-"))

    # JVM warm-up on a smaller scale (other data, so nothing timed is cached).
    warm_dir = WARM_DIR if os.path.isdir(WARM_DIR) and os.path.abspath(WARM_DIR) != os.path.abspath(sf_dir) \
        else "/root/testdata/sf0.001"
    for name in WARM_UP:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
