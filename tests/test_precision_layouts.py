"""Wrong answers that the test tables cannot show: tiny and huge values, NULL keys,
dropped columns, compaction, uncommitted files, typed partition values."""

import pytest
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark.functions import exact_avg, exact_sum
from tidemark.plans import layout as lay
from tidemark.plans.versioned import VersionedTable
from tidemark.registry import QUERIES
from tidemark.sources.messages import good_trades, parse_trades
from tidemark.streaming.lateness import out_of_order

from conftest import SF01


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_and_huge_values_sum(spark):
    small = spark.range(1000).select(F.lit("A").alias("symbol"), F.lit(60000).cast("long").alias("ts"),
                                     F.lit(0.00001234).alias("price"), F.lit(0.00001).alias("qty"),
                                     F.lit("BUY").alias("side"), F.col("id").alias("seq"))
    huge = spark.createDataFrame([("B", 60000, 1e15, 1e-20, "SELL", 1), ("B", 60001, 1e15, 2e300, "SELL", 2)], small.schema)
    t = small.unionByName(huge).withColumn("event_time", F.timestamp_millis("ts"))
    bars = {r["symbol"]: r for r in ops.ohlcv_bars(t).collect()}
    assert bars["A"]["total_qty"] == 0.01 and bars["A"]["buy_qty"] == 0.01
    assert bars["B"]["total_qty"] == 2e300
    summary = {r["symbol"]: r for r in ops.symbol_summary(t).collect()}
    assert summary["A"]["avg_price"] == pytest.approx(0.00001234, rel=1e-12) and summary["B"]["avg_price"] == 1e15
    assert ops.buy_pressure(ops.ohlcv_bars(t)).count() == 2
    s = {r["symbol"]: r["qty"] for r in ops.sessions(t, ["symbol"], "event_time", "1 minute", ("qty",)).collect()}
    assert s == {"A": 0.01, "B": 2e300}
    m = {(r["symbol"], r["avg_price"]) for r in ops.moving_average(t).collect()}
    assert ("B", 1e15) in m and len(m) == 2


def test_sum_of_nothing_and_of_nan(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (2, 1.0), (3, 0.1), (3, None)], "k int, x double")
    got = {r["k"]: (r["s"], r["a"]) for r in df.groupBy("k").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).collect()}
    assert got[1] == (None, None) and got[3] == (0.1, 0.1) and got[2][0] != got[2][0]


def test_sessions_send_panes_not_rows(spark):
    p = plan(ops.sessions(spark.read.parquet(f"{SF01}/events.parquet"), ["user_id"], "ts"))
    first_exchange = p.rindex("Exchange hashpartitioning")
    assert "partial_count" in p[first_exchange:]


def test_windows_expand_panes_not_rows(spark):
    for name in ("sliding_counts", "moving_average"):
        p = plan(QUERIES[name](spark, SF01))
        assert "Expand" in p and "partial_count" in p[p.index("Expand"):]


def test_registered_time_slice_is_pushed(spark):
    assert "GreaterThanOrEqual(ts" in plan(QUERIES["time_slice"](spark, SF01))


def test_dropped_field_ids_are_not_reused(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/ids")
    t.commit(spark.createDataFrame([(1, "7")], "id int, props string"))
    t.drop_column("props")
    t.add_column("k", "int")
    assert [tuple(r) for r in t.snapshot().collect()] == [(1, None)]


def test_compaction_and_rollback_change_no_rows(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/log")
    t.commit(spark.createDataFrame([(1,), (2,)], "id int"))
    t.commit(spark.createDataFrame([(3,)], "id int"))
    t.compact()
    assert t.diff(2, 3).count() == 0
    t.rollback_to(1)
    t.commit(spark.createDataFrame([(4,)], "id int"))
    assert [tuple(r) for r in t.rows_growing().orderBy("version").collect()] == [
        (1, 2, 2, True), (2, 1, 3, True), (3, 0, 3, False), (4, 0, 2, False), (5, 1, 3, True)]
    assert sorted(map(tuple, t.diff(3, 5).collect())) == [(3, "removed"), (4, "added")]
    assert "Scan parquet" not in plan(t.rows_growing()) and "/data" not in plan(t.snapshots())


def test_uncommitted_files_are_not_listed(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/crash")
    rows = spark.createDataFrame([(1,)], "id int")
    assert t.files().count() == 0
    t.commit(rows)
    rows.write.parquet(f"{t.data_path}/batch_id=2")
    assert {r["batch_id"] for r in t.files().collect()} == {1}
    assert [(r["batch_id"], r["row_count"]) for r in t.manifests().collect()] == [(1, 1)]


def test_null_keys_diff_and_order(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/nk", keys=["symbol"])
    t.commit(spark.createDataFrame([(None, 1, 1, 1.0), ("A", 1, 2, 1.0)], "symbol string, ts long, seq long, qty double"))
    t.commit(spark.createDataFrame([("A", 2, 3, 2.0)], "symbol string, ts long, seq long, qty double"))
    assert [(r["symbol"], r["change"]) for r in t.diff(1, 2).collect()] == [("A", "changed")]
    feed = spark.createDataFrame([(0, None, 1, 100), (0, None, 5000, 50)], "partition int, key string, offset long, ts long")
    assert out_of_order(feed).first()["out_of_order"] == 1


def test_partition_values_keep_their_types(spark, tmp_root):
    df = spark.createDataFrame([("007", 5.0), ("010", 6.0)], "code string, x double")
    ident = [lay.Part("identity", "code", "code_part"), lay.truncate(2, "code")]
    lay.write_layout(df, f"{tmp_root}/i", ident)
    got = lay.read_layout(spark, f"{tmp_root}/i", ident)
    assert sorted((r["code_part"], r["code_trunc"]) for r in got.collect()) == [("007", "00"), ("010", "01")]
    own = [lay.Part("identity", "code", "code")]
    lay.write_layout(df, f"{tmp_root}/own", own)
    assert sorted(r["code"] for r in lay.read_layout(spark, f"{tmp_root}/own", own).collect()) == ["007", "010"]
    one = lay.pruned_read(spark, f"{tmp_root}/i", ident, "code", equals="007")
    pre = lay.pruned_read(spark, f"{tmp_root}/i", ident, "code", prefix="0")
    assert one.count() == 1 and pre.count() == 2
    assert "PartitionFilters: [isnotnull(code_part" in plan(one)
    assert "PartitionFilters: [isnotnull(code_trunc" in plan(pre)
    buckets = [lay.bucket(4, "x")]
    lay.write_layout(df, f"{tmp_root}/b", buckets)
    assert lay.pruned_read(spark, f"{tmp_root}/b", buckets, "x", equals=5).count() == 1


def test_day_equality_prunes(spark, tmp_root):
    df = spark.sql("SELECT timestamp_ntz'2024-01-05 03:00:00' AS ts UNION ALL SELECT timestamp_ntz'2024-01-06 03:00:00'")
    lay.write_layout(df, f"{tmp_root}/d", [lay.days("ts")])
    got = lay.pruned_read(spark, f"{tmp_root}/d", [lay.days("ts")], "ts", equals="2024-01-05 03:00:00")
    assert got.count() == 1 and "PartitionFilters: [isnotnull(ts_day" in plan(got)


def test_strict_refuses_empty_messages(spark):
    m = spark.createDataFrame([(0, 1, "A", '{"symbol":"A","ts":1,"price":2.0,"qty":1.0,"side":"BUY"}')],
                              "partition int, offset long, key string, value string")
    assert good_trades(parse_trades(m, mode="strict")).count() == 1
    for text in (None, "", "{}"):
        bad = m.withColumn("value", F.lit(text).cast("string"))
        with pytest.raises(Exception):
            good_trades(parse_trades(bad, mode="strict")).collect()
