"""Streams with state of their own: idle keys, reordering, panes, keyed raw rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import jobs as sp
from tidemark.streaming import state as st

HOUR = 3_600_000
BASE = 1000 * HOUR  # a stream's watermark begins at the epoch, and rows at it are late


def write(spark, path, rows):
    """Rows (symbol, ts, seq) as one stored file of the trade log."""
    df = spark.createDataFrame([(s, BASE + t, 1.0, 2.0, "BUY", q) for s, t, q in rows], "symbol string, ts long, price double, qty double, side string, seq long")
    df.withColumn("event_time", F.expr("timestamp_millis(ts)")).coalesce(1).write.mode("append").parquet(path)


def read(spark, path):
    return spark.readStream.schema(sp.LOG_SCHEMA).parquet(path)


def test_an_idle_key_starts_anew(spark, tmp_root):
    def go(rows):
        write(spark, f"{tmp_root}/in", rows)
        st.stream_running_totals(read(spark, f"{tmp_root}/in"), f"{tmp_root}/out", f"{tmp_root}/ckpt", "24 hours")
        return {r["symbol"]: (r["first_ts"] - BASE, r["event_count"], r["qty"]) for r in st.read_running_totals(spark, f"{tmp_root}/out").collect()}
    assert go([("a", 0, 1), ("a", HOUR, 2), ("b", 0, 3)]) == {"a": (0, 2, 4.0), "b": (0, 1, 2.0)}
    assert go([("a", 20 * HOUR, 4)]) == {"a": (0, 3, 6.0), "b": (0, 1, 2.0)}
    # 43 h: b has been idle for 43 hours and is gone, a for 23.
    assert go([("a", 43 * HOUR, 5)])["a"] == (0, 4, 8.0)
    assert go([("b", 43 * HOUR + 1, 6), ("c", 90 * HOUR, 7)])["b"] == (43 * HOUR + 1, 1, 2.0)
    assert go([("a", 90 * HOUR, 8)])["a"] == (90 * HOUR, 1, 2.0)


def test_arrival_order_does_not_matter(spark, tmp_root):
    rows = [(s, t * 700, t * 2 + (s == "b")) for t in range(40) for s in ("a", "b")] + [("a", 1400, 999)]
    outs = []
    for k in range(2):
        base = f"{tmp_root}/{k}"
        for part in (rows[:40], rows[40:], [("a", 10 * HOUR, 10_000)]):
            part = list(part)
            random.Random(k).shuffle(part)
            write(spark, f"{base}/in", part)
            st.stream_reordered(read(spark, f"{base}/in"), f"{base}/out", f"{base}/ckpt", "1 hour")
        outs.append(sorted(map(tuple, spark.read.schema(st.RELEASED).parquet(f"{base}/out/batch_id=*").collect())))
    want = []
    for s in ("a", "b"):
        own = sorted((t, q) for x, t, q in rows if x == s)
        want += [(s, n + 1, BASE + t, q, 1.0, 2.0) for n, (t, q) in enumerate(own)]
    assert outs[0] == outs[1] == want


def test_rows_are_not_copied_into_sliding_windows(spark, tmp_root):
    write(spark, f"{tmp_root}/in", [("a", 0, 1)])
    stream = read(spark, f"{tmp_root}/in").withWatermark("event_time", "5 seconds")
    plan = st.sliding_by_panes(stream, "5 minutes", "1 minute")._jdf.queryExecution().analyzed().toString()
    assert plan.index("Expand") < plan.index("Aggregate", plan.index("Expand"))  # the copies lie above the aggregate by pane
    assert "Expand" not in plan[plan.index("Aggregate", plan.index("Expand")):]


def test_replayed_rows_are_not_written_twice(spark, tmp_root):
    rows = [("a", i * 1000, i) for i in range(50)]
    for part in (rows[:30], rows[20:], rows, [("a", 5 * HOUR, 99)], rows[:3]):
        write(spark, f"{tmp_root}/in", part)
        st.stream_keyed_raw(read(spark, f"{tmp_root}/in"), ["symbol", "ts", "seq"], f"{tmp_root}/raw", f"{tmp_root}/ckpt")
    got = sorted(r["seq"] for r in spark.read.parquet(f"{tmp_root}/raw").collect())
    assert got == [*range(50), 99]


def test_observed_rows_flag_a_stalled_batch(spark, tmp_root):
    runs = []
    for part in ([("a", 1, 1), ("a", 2, 2)], [("b", 3, 3)]):
        write(spark, f"{tmp_root}/in", part)
        log = read(spark, f"{tmp_root}/in").where("symbol = 'a'")
        runs.append(sp.append_log(st.observe_rows(log), f"{tmp_root}/log", f"{tmp_root}/ckpt"))
    got = st.observed_growth(spark, runs).orderBy("batch_id").collect()
    assert [(r["rows"], r["total"], r["growing"]) for r in got] == [(2, 2, True), (0, 2, False)]
    assert spark.read.parquet(f"{tmp_root}/log").count() == got[-1]["total"]


@pytest.mark.parametrize("text, ms", [("24 hours", 24 * HOUR), ("5 seconds", 5000), ("250 milliseconds", 250)])
def test_milliseconds(spark, text, ms):
    assert st.milliseconds(spark, text) == ms
