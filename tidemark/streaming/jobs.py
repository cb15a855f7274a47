"""Structured Streaming jobs: message stream -> trade log, bars, versioned table.

Layout decisions:

* **Log first.**  The message stream is parsed once and written by Spark's
  native Parquet file sink (exactly-once through its ``_spark_metadata``
  manifest).  Bars and any other consumers read that log as their own
  stream, so the source is read once however many tables are built.
* **Two bar modes.**  ``final``: append mode, a bar is written once, when
  the watermark passes its end.  ``upsert``: update mode; every micro-batch
  commits the bars it changed as one version of a versioned table keyed by
  (symbol, window_start) (commit token = query id and micro-batch id, so
  a replayed batch commits once); the newest micro-batch wins per key.  It also shows
  the still-open windows, and the bar table gets snapshots, time travel and
  compaction like any versioned table.
* Every query takes a checkpoint location; rerunning on the same one
  resumes from the last committed offsets with no loss and no duplicates.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exact import exact_sum
from ..functions.time import to_ntz
from ..operators.bars import bar_aggregates
from ..plans.versioned import VersionedTable
from ..sources.messages import good_trades, parse_trades

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

# Bytes of a micro-batch where its rate is bounded: the number of micro-batches follows the bytes, not the files.
MICRO_BATCH_BYTES = 128 << 20

LOG_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("qty", T.DoubleType()),
    T.StructField("side", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("event_time", T.TimestampType()),
])


# ---------------------------------------------------------------- sources
def write_message_files(messages: DataFrame, path: str) -> None:
    """Store envelope rows as JSON lines (a file-backed stand-in for a topic)."""
    messages.select(*ENVELOPE_SCHEMA.fieldNames()).write.mode("append").json(path)


def _bounded(reader, max_files: int | None, max_bytes: int | None):
    """A micro-batch takes so many files, or files of so many bytes (one at least): many small files then share one."""
    if max_files and max_bytes:
        raise ValueError("bound a micro-batch by max_files or by max_bytes")
    if max_bytes:
        return reader.option("maxBytesPerTrigger", max_bytes)
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def message_stream(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    return _bounded(spark.readStream.schema(ENVELOPE_SCHEMA), max_files, max_bytes).json(path)


def trade_stream(messages: DataFrame, lateness: str | None = "5 seconds",
                 mode: str = "lenient") -> DataFrame:
    """Parse (lenient: bad rows skipped; strict: the query fails on one),
    offset as seq, event-time watermark (on TIMESTAMP, not NTZ)."""
    t = good_trades(parse_trades(messages, mode=mode))
    return t.withWatermark("event_time", lateness) if lateness else t


def log_stream(spark: SparkSession, log_path: str, lateness: str | None = "5 seconds",
               max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """The stored trade log as a stream (read through the sink's manifest)."""
    t = _bounded(spark.readStream.schema(LOG_SCHEMA), max_files, max_bytes).parquet(log_path)
    return t.withWatermark("event_time", lateness) if lateness else t


# ---------------------------------------------------------------- running
def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def run(writer, trigger: str | None = None, timeout: float | None = None):
    """Start a stream; with availableNow, block until all input is processed."""
    q = _trigger(writer, trigger).start()
    if trigger is None or trigger == "availableNow":
        q.awaitTermination(timeout)
        if q.exception():
            raise q.exception()
    return q


def checkpointed(writer, checkpoint: str, interval: str = "60 seconds"):
    """Periodic micro-batches with a durable checkpoint (exactly-once sinks)."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval)


# ---------------------------------------------------------------- sinks
def append_log(trades: DataFrame, path: str, checkpoint: str, trigger: str | None = None):
    """Every accepted trade, exactly once, in Parquet."""
    w = (trades.select(*LOG_SCHEMA.fieldNames()).writeStream.format("parquet")
         .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    return run(w, trigger)


def bars_query(trades: DataFrame, size: str = "1 minute") -> DataFrame:
    g = trades.groupBy("symbol", F.window("event_time", size).alias("w")).agg(*bar_aggregates())
    return g.select("symbol", to_ntz("w.start").alias("window_start"), to_ntz("w.end").alias("window_end"),
                    *[c for c in g.columns if c not in ("symbol", "w")])


def stream_bars(trades: DataFrame, path: str, checkpoint: str, size: str = "1 minute",
                mode: str = "final", trigger: str | None = None):
    bars = bars_query(trades, size)
    if mode == "final":
        w = (bars.writeStream.format("parquet").option("path", path)
             .option("checkpointLocation", checkpoint).outputMode("append"))
        return run(w, trigger)
    if mode == "upsert":
        table = bar_table(trades.sparkSession, path)

        def write_batch(df: DataFrame, batch_id: int) -> None:
            df.persist()  # used twice below: compute the micro-batch once
            try:
                if df.isEmpty():  # watermark-only micro-batch: nothing changed
                    return
                table.refresh()
                order = 1 + max((r.version for r in table._log()), default=0)  # grows on under a new checkpoint too
                table.commit(df.withColumn("_mb", F.lit(order).cast("long")),
                             token=f"bars:{query_id(df, checkpoint)}:{batch_id}")
            finally:
                df.unpersist()
        w = (bars.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint).outputMode("update"))
        return run(w, trigger)
    raise ValueError("mode must be 'final' or 'upsert'")


def query_id(df: DataFrame, checkpoint: str) -> str:
    """The id that Spark gave the query of this checkpoint; a new checkpoint has a new one."""
    return json.loads(df.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def bar_table(spark: SparkSession, path: str) -> VersionedTable:
    """Upsert-mode bars: a versioned table keyed by (symbol, window_start);
    a bar updated in a later micro-batch replaces the earlier row."""
    return VersionedTable(spark, path, keys=["symbol", "window_start"], ts="_mb", seq="_mb")


def read_upsert_bars(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Current (or as-of ``version``) bars of an upsert-mode bar table."""
    return bar_table(spark, path).snapshot(version).drop("_mb")


def stream_sessions(events: DataFrame, keys: list[str], time_col: str, path: str, checkpoint: str,
                    gap: str = "5 minutes", trigger: str | None = None, sum_cols: tuple[str, ...] = ()):
    """Session windows in append mode: a session is written once it is closed.

    With a long gap this is also a running summary with state expiry: a
    key's state lives while events keep coming and is emitted and dropped
    once the watermark passes last event + gap (e.g. 24 h idle).
    """
    g = (events.groupBy(*keys, F.session_window(time_col, gap).alias("s"))
         .agg(F.count(F.lit(1)).alias("event_count"), *[exact_sum(c).alias(c) for c in sum_cols]))
    out = g.select(*keys, to_ntz("s.start").alias("session_start"),
                   to_ntz("s.end").alias("session_end"), "event_count", *sum_cols)
    w = (out.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return run(w, trigger)


def run_multi_sink(stream: DataFrame, branches: dict[str, tuple[Callable[[DataFrame], DataFrame], str]],
                   checkpoint: str, trigger: str | None = None):
    """Several stateless outputs from one read of the source.

    Each micro-batch is persisted once and every branch writes its own
    projection/filter of it to ``<path>/batch_id=N`` (overwrite: a replayed
    batch rewrites the same directory, no duplicates).
    """
    def write_batch(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            for name, (fn, path) in branches.items():
                fn(df).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            df.unpersist()
    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return run(w, trigger)


def stream_to_versioned(stream: DataFrame, table, checkpoint: str, name: str,
                        trigger: str | None = None):
    """Each micro-batch becomes one version of a ``VersionedTable``.

    The commit token is (name, query id, micro-batch id), so a micro-batch replayed
    after a failure is committed once.  Readers of the table go through its
    commit log; do not point a file stream at the table's directories.
    """
    def write_batch(df: DataFrame, batch_id: int) -> None:
        table.commit(df, token=f"{name}:{query_id(df, checkpoint)}:{batch_id}")
    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return run(w, trigger)


def process_time_window(trades: DataFrame, size: str = "1 minute") -> DataFrame:
    """Aggregate by processing time (one wall-clock value per micro-batch)."""
    g = (trades.withColumn("proc_time", F.current_timestamp())
         .groupBy("symbol", F.window("proc_time", size).alias("w"))
         .agg(F.count(F.lit(1)).alias("trade_count")))
    return g.select("symbol", to_ntz("w.start").alias("window_start"),
                    to_ntz("w.end").alias("window_end"), "trade_count")
