"""Streams over many files, hot keys and many keys: micro-batches, state and calls that follow the bytes, not files or keys."""

import pytest
from pyspark.sql import functions as F

from tidemark import registry
from tidemark.sources.messages import to_messages
from tidemark.streaming import jobs as sp
from tidemark.streaming import state as st


def write_events(spark, sf, n, files):
    """Events of two types every 6200 s over January 2024, in so many files."""
    rows = spark.range(n).selectExpr(
        "id AS event_id", "timestamp_micros(1704067200000000 + id * 6200000000) AS ts", "id % 7 AS user_id",
        "IF(id % 2 = 0, 'view', 'click') AS event_type", "id * 0.25 AS value", "concat('{\"k\": ', id % 50, '}') AS props")
    rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")).repartition(files).write.parquet(f"{sf}/events.parquet")


def test_small_files_share_a_micro_batch(spark, tmp_root, monkeypatch):
    write_events(spark, f"{tmp_root}/sf", 400, 10)
    monkeypatch.setattr(registry, "scratch_path", lambda s, name: f"{tmp_root}/{name}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # a file a partition, so ten message files a half
    try:
        got = registry.QUERIES["raw_and_bars_stream"](spark, f"{tmp_root}/sf")
        counts = {r["target"]: r["count"] for r in got.groupBy("target").count().collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert counts == {"raw_trades": 400, "bars_1m": 400}
    base = f"{tmp_root}/raw_and_bars_stream"
    assert spark.read.text(f"{base}/in").select(F.input_file_name()).distinct().count() > 10
    assert sp.bar_table(spark, f"{base}/bars").current_version() == 2  # one a half


def test_a_micro_batch_is_bounded_by_bytes(spark, tmp_root):
    m = to_messages(spark.range(40).selectExpr("'a' AS symbol", "id AS ts", "1.0D AS price", "2.0D AS qty", "'BUY' AS side", "id AS seq"))
    sp.write_message_files(m.repartition(8), f"{tmp_root}/in")
    for name, most, batches in (("each", 1, 8), ("all", 1 << 20, 1)):
        trades = sp.trade_stream(sp.message_stream(spark, f"{tmp_root}/in", max_bytes=most), None)
        q = sp.append_log(trades, f"{tmp_root}/{name}", f"{tmp_root}/ckpt_{name}")
        assert sum(p["numInputRows"] > 0 for p in q.recentProgress) == batches
        assert spark.read.parquet(f"{tmp_root}/{name}").count() == 40
    with pytest.raises(ValueError):
        sp.message_stream(spark, f"{tmp_root}/in", max_files=1, max_bytes=1)


def test_a_hot_symbols_rows_are_held_in_many_tasks(spark, tmp_root):
    hour = 3_600_000

    def write(low, high):
        rows = spark.range(low, high).selectExpr("'hot' AS symbol", f"{1000 * hour} + id * 60000 AS ts", "CAST(id AS double) AS price", "1.0D AS qty",
                                                 "'BUY' AS side", "id AS seq", f"timestamp_millis({1000 * hour} + id * 60000) AS event_time")
        rows.repartition(3).write.mode("append").parquet(f"{tmp_root}/in")
        stream = spark.readStream.schema(sp.LOG_SCHEMA).parquet(f"{tmp_root}/in")
        st.stream_reordered(stream, f"{tmp_root}/out", f"{tmp_root}/ckpt", "3 hours")
    write(0, 400)  # held: the last three hours
    state = spark.read.format("statestore").load(f"{tmp_root}/ckpt")
    assert state.count() == 180 and state.select("partition_id").distinct().count() > 4
    write(400, 700)
    got = spark.read.schema(st.RELEASED).parquet(f"{tmp_root}/out/batch_id=*").orderBy("n").collect()
    assert [(r["n"], r["seq"], r["price"]) for r in got] == [(i + 1, i, float(i)) for i in range(520)]  # numbers go on over panes and runs


def test_many_keys_share_a_call(spark, tmp_root):
    def go(low, high):
        rows = spark.range(low, high).selectExpr("IF(id = 7, NULL, id % 2000) AS k", "timestamp_millis(1700000000000 + (id div 2000) * 9000) AS event_time",
                                                 "CASE WHEN id = 5 THEN CAST('NaN' AS double) WHEN id = 6 THEN NULL ELSE 0.5D END AS x")
        rows.write.mode("append").parquet(f"{tmp_root}/in")
        stream = spark.readStream.schema("k long, event_time timestamp, x double").parquet(f"{tmp_root}/in").withWatermark("event_time", "1 second")
        return st.stream_sessions_by_panes(stream, ["k"], "event_time", f"{tmp_root}/out", f"{tmp_root}/ckpt", "10 seconds", sum_cols=("x",))
    go(0, 2000)
    q = go(2000, 6000)
    timers = [int(o["customMetrics"]["numRegisteredTimers"]) for p in q.recentProgress for o in p["stateOperators"] if "numRegisteredTimers" in o["customMetrics"]]
    assert timers and max(timers) <= 256  # not one a key
    go(2_000_000, 2_000_001)
    got = {r["k"]: (r["event_count"], repr(r["x"])) for r in spark.read.parquet(f"{tmp_root}/out/batch_id=*").collect()}
    assert len(got) == 2001 and got[None] == (1, "0.5") and got[7] == (2, "1.0")
    assert got[5] == (3, "nan") and got[6] == (3, "1.0") and got[1999] == (3, "1.5")


def test_keys_of_any_type_come_back_as_they_were(spark, tmp_root):
    rows = """(1700000000000000, 'é"\\n', CAST('NaN' AS double), X'00ff', DATE'2024-02-29', TIMESTAMP'2024-01-01 00:00:00.000001', 1.50BD, array(1, NULL)),
              (1700000000000001, '', -1e300D, X'', NULL, NULL, NULL, NULL), (1700000000000002, NULL, NULL, NULL, DATE'0001-01-01', TIMESTAMP'1900-01-01 00:00:00', -1.5BD, array()),
              (1800000000000000, 'end', 0D, X'00', NULL, NULL, NULL, NULL)"""
    df = spark.sql(f"SELECT timestamp_micros(at) AS event_time, s, d, b, day, t, n, a FROM VALUES {rows} AS v(at, s, d, b, day, t, n, a)")
    df.write.parquet(f"{tmp_root}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_root}/in").withWatermark("event_time", "1 second")
    st.stream_sessions_by_panes(stream, ["s", "d", "b", "day", "t", "n", "a"], "event_time", f"{tmp_root}/out", f"{tmp_root}/ckpt", "10 seconds")
    got = spark.read.parquet(f"{tmp_root}/out/batch_id=*").select("s", "d", "b", "day", "t", "n", "a")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.where("s IS DISTINCT FROM 'end'").drop("event_time").collect()))
