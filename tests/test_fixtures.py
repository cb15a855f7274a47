"""Hand-made fixtures, one per semantic that is easy to get wrong."""

import datetime as dt
import itertools
import random

import pytest

from tidemark import operators as ops
from tidemark.functions.time import event_time
from tidemark.sources.messages import good_trades, parse_trades, quarantine
from tidemark.streaming import jobs as sp
from tidemark.streaming.lateness import late_rows

T0 = 1_704_103_200_000  # 2024-01-01 10:00:00 UTC in epoch ms


def trades_df(spark, rows):
    """rows: (symbol, ts_ms, price, qty, side, seq)."""
    df = spark.createDataFrame(rows, "symbol string, ts long, price double, qty double, side string, seq long")
    return df.withColumn("event_time", event_time("ts"))


def ntz(s):
    return dt.datetime.fromisoformat(s)


# ------------------------------------------------------------------ json_mixed
def test_json_mixed(spark):
    vals = ['{"symbol":"BTCUSDT","ts":1705641234567,"price":42150.5,"qty":0.15,"side":"BUY"}',
            '{"symbol":"ETHUSDT","price":2500.1}', "not json",
            '{"symbol":"X","ts":"abc","price":1.0}', "[1]", "", None]
    msgs = spark.createDataFrame([(0, i, "k", v) for i, v in enumerate(vals)],
                                 "partition int, offset long, key string, value string")
    parsed = parse_trades(msgs)
    good = good_trades(parsed)
    assert good.count() == 2
    assert quarantine(parsed).count() == 5
    bars = ops.ohlcv_bars(good)
    assert bars.count() == 1  # the row without ts falls in no window


def test_strict_mode_fails_on_bad_row(spark):
    msgs = spark.createDataFrame([(0, 0, "k", "not json")], "partition int, offset long, key string, value string")
    with pytest.raises(Exception):
        parse_trades(msgs, mode="strict").collect()


# ------------------------------------------------------------------ same_ms
def test_same_ms_log_upsert_bars(spark):
    t = trades_df(spark, [("BTC", T0, 100.0, 1.0, "BUY", 1), ("BTC", T0, 101.0, 2.0, "SELL", 2)])
    assert t.count() == 2
    up = ops.upsert_by_key(t, ["symbol", "ts"]).collect()
    assert len(up) == 1 and up[0].price == 101.0 and up[0].seq == 2
    bar = ops.ohlcv_bars(t).collect()[0]
    assert bar.trade_count == 2
    assert (bar.open_price, bar.close_price) == (100.0, 101.0)


# ------------------------------------------------------------------ arrival_shuffle
def test_arrival_order_does_not_change_bars(spark):
    rng = random.Random(7)
    rows = [("ETH", T0 + rng.randrange(60_000), round(rng.uniform(2400, 2600), 2),
             round(rng.uniform(0.01, 10), 4), rng.choice(["BUY", "SELL"]), i) for i in range(200)]
    results = set()
    for k in range(3):
        shuffled = rows[:]
        random.Random(k).shuffle(shuffled)
        df = trades_df(spark, shuffled).repartition(4 + k)
        results.add(tuple(ops.ohlcv_bars(df).collect()[0]))
    assert len(results) == 1


# ------------------------------------------------------------------ minute_edge
def test_minute_edges(spark):
    t = trades_df(spark, [("A", T0 + 30_000, 1.0, 1.0, "BUY", 1),
                          ("A", T0 + 60_000, 2.0, 1.0, "BUY", 2),
                          ("A", T0 + 75_000, 3.0, 1.0, "BUY", 3)])
    got = sorted((r.window_start, r.window_end, r.trade_count) for r in ops.ohlcv_bars(t).collect())
    assert got == [(ntz("2024-01-01 10:00:00"), ntz("2024-01-01 10:01:00"), 1),
                   (ntz("2024-01-01 10:01:00"), ntz("2024-01-01 10:02:00"), 2)]


# ------------------------------------------------------------------ late_edge (streaming)
def test_late_edge_stream_and_late_rows(spark, tmp_root):
    arrivals = [[0, 59_999], [64_999], [30_000], [65_000], [31_000, 66_000]]
    inp, out, ckpt = f"{tmp_root}/in", f"{tmp_root}/bars", f"{tmp_root}/ckpt"
    seq = itertools.count()
    for batch in arrivals:
        rows = [(0, next(seq), "A",
                 f'{{"symbol":"A","ts":{T0 - 36_000_000 + ms},"price":1.0,"qty":1.0,"side":"BUY"}}')
                for ms in batch]
        spark.createDataFrame(rows, sp.ENVELOPE_SCHEMA).coalesce(1).write.mode("append").json(inp)
        trades = sp.trade_stream(sp.message_stream(spark, inp))
        sp.stream_bars(trades, out, ckpt, "1 minute", "final")
    bars = spark.read.parquet(out).collect()
    assert [(b.trade_count) for b in bars] == [3]
    # The batch formulation returns the one dropped row.
    flat = [(ms, b) for b, batch in enumerate(arrivals) for ms in batch]
    t = trades_df(spark, [("A", T0 - 36_000_000 + ms, 1.0, 1.0, "BUY", i) for i, (ms, _) in enumerate(flat)])
    t = t.join(spark.createDataFrame([(i, b) for i, (_, b) in enumerate(flat)], "seq long, batch long"), "seq")
    dropped = [r.ts - (T0 - 36_000_000) for r in late_rows(t, "batch").collect()]
    assert dropped == [31_000]


# ------------------------------------------------------------------ odd_side / zero_volume
def test_odd_side(spark):
    t = trades_df(spark, [("A", T0, 1.0, 1.0, "BUY", 1), ("A", T0 + 1, 1.0, 2.0, "SELL", 2),
                          ("A", T0 + 2, 1.0, 4.0, "CROSS", 3), ("A", T0 + 3, 1.0, 8.0, None, 4)])
    b = ops.ohlcv_bars(t).collect()[0]
    assert b.total_qty == 15.0 and b.trade_count == 4
    assert (b.buy_qty, b.sell_qty) == (1.0, 2.0)


def test_zero_volume_bar_not_in_buy_pressure(spark):
    t = trades_df(spark, [("A", T0, 1.0, 0.0, "BUY", 1), ("B", T0, 1.0, 2.0, "BUY", 2)])
    p = ops.buy_pressure(ops.ohlcv_bars(t)).collect()
    assert [r.symbol for r in p] == ["B"] and p[0].buy_pct == 100.0


# ------------------------------------------------------------------ session_edge
@pytest.mark.parametrize("bucket", ["1 day", "3 minutes", "1 minute"])
def test_session_edge(spark, bucket):
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    ts = [base, base + dt.timedelta(minutes=5), base + dt.timedelta(minutes=9, seconds=59, microseconds=999000),
          base + dt.timedelta(minutes=15, milliseconds=1)]
    df = spark.createDataFrame([(1, t) for t in ts], "user_id long, ts timestamp_ntz")
    got = sorted((r.session_start, r.session_end, r.event_count)
                 for r in ops.sessions(df, ["user_id"], "ts", "5 minutes", bucket=bucket).collect())
    assert got == [(base, base + dt.timedelta(minutes=14, seconds=59, microseconds=999000), 3),
                   (ts[3], ts[3] + dt.timedelta(minutes=5), 1)]


# ------------------------------------------------------------------ hop_edge
def test_hop_edge(spark):
    t = trades_df(spark, [("A", T0 + 60_000, 1.0, 1.0, "BUY", 1)])
    got = sorted((r.window_start, r.window_end) for r in ops.sliding_counts(t, "2 minutes", "1 minute").collect())
    assert got == [(ntz("2024-01-01 10:00:00"), ntz("2024-01-01 10:02:00")),
                   (ntz("2024-01-01 10:01:00"), ntz("2024-01-01 10:03:00"))]


def test_prefix_scan_matches_running_max(spark):
    from tidemark.streaming.lateness import prefix_max_before
    rng = random.Random(5)
    rows = [(k, i, rng.randrange(1000)) for k in range(3) for i in range(0, 700, rng.choice([1, 2, 3]))]
    df = spark.createDataFrame(rows, "k long, o long, v long")
    got = {(r.k, r.o): r.v_before for r in prefix_max_before(df, "o", "v", block=4, groups=("k",)).collect()}
    best = {}
    for k, o, v in sorted(rows):
        assert got[(k, o)] == best.get(k)
        best[k] = max(best.get(k, v), v)


# ------------------------------------------------------------------ running summary with 24 h expiry
def test_running_summary_state_expires_after_idle_day(spark, tmp_root):
    day = 86_400_000
    batches = [[0, 3_600_000], [day + 3_600_000 - 1], [3 * day], [5 * day]]
    inp, out, ckpt = f"{tmp_root}/in", f"{tmp_root}/out", f"{tmp_root}/ckpt"
    seq = itertools.count()
    for batch in batches:
        rows = [(0, next(seq), "A", f'{{"symbol":"A","ts":{T0 + ms},"price":1.0,"qty":2.0,"side":"BUY"}}')
                for ms in batch]
        spark.createDataFrame(rows, sp.ENVELOPE_SCHEMA).coalesce(1).write.mode("append").json(inp)
        trades = sp.trade_stream(sp.message_stream(spark, inp))
        sp.stream_sessions(trades, ["symbol"], "event_time", out, ckpt, "24 hours", sum_cols=("qty",))
    got = sorted((r.event_count, r.qty) for r in spark.read.parquet(out).collect())
    # first state: 3 trades within 24 h of each other; second: the trade at day 3 (closed by day 5)
    assert got == [(1, 2.0), (3, 6.0)]


def test_strict_stream_fails_lenient_stream_skips(spark, tmp_root):
    rows = [(0, 0, "A", '{"symbol":"A","ts":1,"price":1.0,"qty":1.0,"side":"BUY"}'), (0, 1, "A", "not json")]
    spark.createDataFrame(rows, sp.ENVELOPE_SCHEMA).coalesce(1).write.json(f"{tmp_root}/in")
    sp.append_log(sp.trade_stream(sp.message_stream(spark, f"{tmp_root}/in"), None),
                  f"{tmp_root}/ok", f"{tmp_root}/ck1")
    assert spark.read.parquet(f"{tmp_root}/ok").count() == 1
    with pytest.raises(Exception):
        sp.append_log(sp.trade_stream(sp.message_stream(spark, f"{tmp_root}/in"), None, "strict"),
                      f"{tmp_root}/bad", f"{tmp_root}/ck2")
