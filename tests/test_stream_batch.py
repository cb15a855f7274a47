"""Stream = batch: bars from a multi-batch replay equal the batch bars."""

from pyspark.sql import functions as F

from conftest import SF001
from tidemark import operators as ops
from tidemark.sources.messages import to_messages
from tidemark.sources.trades import load_trades
from tidemark.streaming import jobs as sp


def _replay_files(spark, root, chunks=4):
    """Messages written one file per time slice, in event-time order."""
    trades = load_trades(spark, SF001)
    bounds = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-02-01"][:chunks + 1]
    for lo, hi in zip(bounds, bounds[1:]):
        part = trades.where((F.col("event_time") >= F.lit(lo).cast("timestamp"))
                            & (F.col("event_time") < F.lit(hi).cast("timestamp")))
        sp.write_message_files(to_messages(part).coalesce(1), f"{root}/in")
    return trades


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_bars_multi_batch_equal_batch(spark, tmp_root):
    trades = _replay_files(spark, tmp_root)
    stream = sp.trade_stream(sp.message_stream(spark, f"{tmp_root}/in", max_files=1))
    sp.stream_bars(stream, f"{tmp_root}/bars", f"{tmp_root}/ckpt", "1 hour", "upsert")
    table = sp.bar_table(spark, f"{tmp_root}/bars")
    assert table.current_version() >= 4  # one version per micro-batch
    expected = _rows(ops.ohlcv_bars(trades, "1 hour"))
    assert _rows(sp.read_upsert_bars(spark, f"{tmp_root}/bars")) == expected
    # Earlier versions hold the bars as of an earlier micro-batch.
    assert len(_rows(sp.read_upsert_bars(spark, f"{tmp_root}/bars", 1))) < len(expected)
    # Compaction keeps the answer and leaves one batch for the current version.
    table.compact()
    assert table.visible_batches() == [table.current_version()]
    assert _rows(sp.read_upsert_bars(spark, f"{tmp_root}/bars")) == expected


def test_final_bars_multi_batch_equal_closed_batch_bars(spark, tmp_root):
    trades = _replay_files(spark, tmp_root)
    stream = sp.trade_stream(sp.message_stream(spark, f"{tmp_root}/in", max_files=1))
    sp.stream_bars(stream, f"{tmp_root}/bars", f"{tmp_root}/ckpt", "1 hour", "final")
    wm = trades.agg(F.max("event_time")).first()[0]
    closed = ops.ohlcv_bars(trades, "1 hour").where(
        F.col("window_end") <= F.lit(wm).cast("timestamp_ntz") - F.expr("INTERVAL 5 SECONDS"))
    assert _rows(spark.read.parquet(f"{tmp_root}/bars")) == _rows(closed)
