"""Streaming sessions by panes: the batch sessions' rows, gaps and restarts, hot and NULL keys."""

import random

from pyspark.sql import functions as F

from tidemark.operators.sessions import sessions
from tidemark.streaming import state as st

BASE = 1_700_000_000_000  # ms; a multiple of no gap below
GAP = 10_000
SCHEMA = "k string, ms long, x double"


def write(spark, path, rows):
    df = spark.createDataFrame([(k, None if ms is None else BASE + ms, x) for k, ms, x in rows], SCHEMA)
    df.withColumn("event_time", F.expr("timestamp_millis(ms)")).coalesce(1).write.mode("append").parquet(path)


def read(spark, path):
    return spark.readStream.schema("k string, ms long, x double, event_time timestamp").parquet(path).withWatermark("event_time", "1 second")


def run(spark, base, parts):
    for part in parts:
        write(spark, f"{base}/in", part)
        st.stream_sessions_by_panes(read(spark, f"{base}/in"), ["k"], "event_time", f"{base}/out", f"{base}/ckpt", "10 seconds", sum_cols=("x",))
    return sorted(map(repr, (tuple(r) for r in spark.read.parquet(f"{base}/out/batch_id=*").collect())))


def test_sessions_over_restarts_equal_the_batch_ones(spark, tmp_root):
    r = random.Random(3)
    rows = []
    for key, step in (("hot", 2_000), ("slow", 9_000), (None, 15_000)):
        t = 0
        while t < 300_000:
            rows.append((key, t, r.choice([None, 0.1, 2.7, 1e12])))
            t += r.choice([1, GAP, GAP + 1, step, step])
    rows.sort(key=lambda x: x[1])
    cuts = [rows[: len(rows) // 3], rows[len(rows) // 3: len(rows) // 2], rows[len(rows) // 2:]]
    for part in cuts:
        r.shuffle(part)
    end = [("end", 3_600_000, 1.0), (None, None, 5.0)]  # closes all, and a row without a time
    got = run(spark, f"{tmp_root}/a", [*cuts, end])
    timed = spark.createDataFrame([(k, BASE + ms, x) for k, ms, x in rows], SCHEMA).withColumn("t", F.expr("timestamp_millis(ms)"))
    want = sorted(map(repr, (tuple(x) for x in sessions(timed, ["k"], "t", "10 seconds", ("x",)).collect())))
    assert got == want


def test_a_gap_of_exactly_the_limit_joins_and_open_sessions_wait(spark, tmp_root):
    parts = [[("a", 0, 1.0)], [("a", GAP, 1.0), ("b", 0, None)], [("a", 2 * GAP + 1, 1.0), ("c", 4 * GAP, 1.0)]]
    got = run(spark, tmp_root, parts)
    assert len(got) == 2 and any("'a'" in g and ", 2, 2.0" in g for g in got) and any("'b'" in g and ", 1, None" in g for g in got)


def test_a_hot_keys_rows_are_reduced_by_pane_before_the_shuffle(spark, tmp_root):
    write(spark, f"{tmp_root}/in", [("hot", i, 1.0) for i in range(50)])
    panes = st.session_panes(read(spark, f"{tmp_root}/in"), ["k"], "event_time", "10 seconds", ("x",))
    plan = panes._jdf.queryExecution().analyzed().toString()
    grouping = plan[plan.index("Aggregate ["):].split("]")[0]
    assert "k#" in grouping and "window" in grouping
    batch = st.session_panes(spark.read.parquet(f"{tmp_root}/in"), ["k"], "event_time", "10 seconds", ("x",))
    assert batch.agg(F.max("event_count")).first()[0] == 50 and batch.count() == 1
