"""Streams that keep state of their own between micro-batches.

* Running totals per key, visible after every micro-batch; a key that stays
  idle for a time starts anew and its state is dropped.
* A reorder buffer: rows of a key are held until the watermark passes them and
  released in (ts, seq) order with a number each, whatever order they came in; each
  row has a state of its own, so a hot key's rows are held and sorted in many tasks.
* Processing-time windows over many micro-batches, in update mode.
* Sliding windows by panes: a first aggregate per slide, a second one over panes,
  so a row is never copied into its windows.
* Sessions by panes: a first aggregate per (key, pane one gap wide), then one state
  per bucket of keys that joins a key's neighbouring panes, so a hot key's rows meet
  in no single task and many small keys cost no call each.
* A keyed raw table: a key seen within the watermark's delay is not written again.
* Row counts observed while a query runs, without another scan.

State with timers needs the RocksDB state store; ``rocksdb``
sets it for the queries started inside.  A key's rows of one micro-batch reach
one task as a stream of Arrow batches and are never held together; bound the
micro-batch (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) for hot keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Context, localcontext

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.exact import WIDE, finish_sum, part_names, sum_parts
from ..functions.time import interval_micros, to_ntz
from ..session import ROCKSDB_STATE
from .jobs import run

TOTALS = "symbol string, first_ts long, last_ts long, event_count long, qty double"
RELEASED = "symbol string, n long, ts long, seq long, price double, qty double"


@contextmanager
def rocksdb(spark: SparkSession):
    """State of queries started inside is kept in RocksDB."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB_STATE}
    for k, v in ROCKSDB_STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def milliseconds(spark: SparkSession, interval: str) -> int:
    return int(spark.sql(f"SELECT CAST(CAST(INTERVAL {interval} AS INTERVAL SECOND) AS DECIMAL(30, 6)) * 1000").first()[0])


# ---------------------------------------------------------------- running totals
class RunningTotals(StatefulProcessor):
    """One total per key, kept while rows of the key keep coming; a timer drops it once the watermark is ``idle_ms`` past its last row."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "first_ts long, last_ts long, event_count long, qty double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, last, n, qty = self.total.get() if self.total.exists() else (None, None, 0, 0.0)
        waiting = last is not None  # for the timer of an earlier row
        for part in rows:
            low, high = int(part["ts"].min()), int(part["ts"].max())
            first, last = low if first is None else min(first, low), high if last is None else max(last, high)
            n += len(part)
            qty += float(part["qty"].sum())
        self.total.update((first, last, n, qty))
        if not waiting:
            self.handle.registerTimer(last + self.idle_ms)
        yield pd.DataFrame({"symbol": [key[0]], "first_ts": [first], "last_ts": [last], "event_count": [n], "qty": [qty]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.total.exists():
            due = self.total.get()[1] + self.idle_ms
            if due <= timerValues.getCurrentWatermarkInMs():
                self.total.clear()
            else:
                self.handle.registerTimer(due)
        return iter(())

    def close(self) -> None:
        pass


def stream_running_totals(trades: DataFrame, path: str, checkpoint: str, idle: str = "24 hours", lateness: str = "5 seconds",
                          trigger: str | None = None):
    """Per micro-batch, the new totals of the symbols it touched, under ``path/batch_id=N`` (a replayed batch rewrites its own).

    A symbol whose last row the watermark has passed by ``idle`` starts anew.  Idle
    time is event time, so a replay gives the same totals.  NULL quantities add
    nothing; rows without a time, or later than ``lateness``, are left out.
    """
    spark = trades.sparkSession
    timed = trades.where("ts IS NOT NULL").withWatermark("event_time", lateness).select("symbol", "ts", "qty", "event_time")
    totals = timed.groupBy("symbol").transformWithStateInPandas(RunningTotals(milliseconds(spark, idle)), TOTALS, "Update", "EventTime")
    with rocksdb(spark):
        return _written(totals, path, checkpoint, "update", trigger)


def read_running_totals(spark: SparkSession, path: str) -> DataFrame:
    """The last total of each symbol."""
    return _latest(spark, path, ["symbol"])


# ---------------------------------------------------------------- reorder buffer
def stream_reordered(trades: DataFrame, path: str, checkpoint: str, lateness: str = "5 seconds", trigger: str | None = None,
                     pane: str = "1 hour"):
    """Each symbol's rows in (ts, seq) order, numbered from 1, once the watermark has passed them, under ``path/batch_id=N``.

    Rows later than ``lateness`` are dropped by the watermark, rows without time or
    seq are left out; a repeated (ts, seq) of a symbol is one row.  Rows the
    watermark has not reached stay held.

    Rows are held each under its own (symbol, ts, seq), so a hot symbol's rows lie in
    all tasks.  What a micro-batch releases is sorted by (symbol, pane) and numbered on
    from the panes before, whose sizes are summed, and from the symbol's rows of the
    micro-batches before, kept under ``path/_released/batch_id=N``.
    """
    spark = trades.sparkSession
    pane_ms = milliseconds(spark, pane)
    timed = trades.where("event_time IS NOT NULL AND ts IS NOT NULL AND seq IS NOT NULL").withWatermark("event_time", lateness)
    held = timed.groupBy("symbol", "ts", "seq", "event_time").agg(F.last("price").alias("price"), F.last("qty").alias("qty"))

    def write_batch(rows: DataFrame, batch_id: int) -> None:
        s = rows.sparkSession
        rows = rows.select("symbol", "ts", "seq", "price", "qty", F.floor(F.col("ts") / pane_ms).alias("_pane")).persist()  # used three times below
        try:
            panes = rows.groupBy("symbol", "_pane").agg(F.count(F.lit(1)).alias("_rows"))
            before = (s.read.schema("symbol string, n long").parquet(f"{path}/_released/batch_id={batch_id - 1}") if batch_id
                      else s.createDataFrame([], "symbol string, n long"))
            now = before.unionByName(panes.select("symbol", F.col("_rows").alias("n"))).groupBy("symbol").agg(F.sum("n").alias("n"))
            now.write.mode("overwrite").parquet(f"{path}/_released/batch_id={batch_id}")
            earlier = Window.partitionBy("symbol").orderBy("_pane").rowsBetween(Window.unboundedPreceding, -1)
            first = (panes.withColumn("_earlier", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
                     .join(before.withColumnRenamed("symbol", "_s"), F.col("symbol").eqNullSafe(F.col("_s")), "left")
                     .select(F.col("symbol").alias("_s"), F.col("_pane").alias("_p"), (F.col("_earlier") + F.coalesce("n", F.lit(0))).alias("_first")))
            place = F.row_number().over(Window.partitionBy("symbol", "_pane").orderBy("ts", "seq"))
            out = rows.withColumn("_place", place).join(first, F.col("symbol").eqNullSafe(F.col("_s")) & (F.col("_pane") == F.col("_p")))
            (out.select("symbol", (F.col("_first") + F.col("_place")).alias("n"), "ts", "seq", "price", "qty")
             .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
        finally:
            rows.unpersist()
    with rocksdb(spark):
        return run(held.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).outputMode("append"), trigger)


# ---------------------------------------------------------------- windows
def stream_process_time_windows(trades: DataFrame, path: str, checkpoint: str, size: str = "1 minute", trigger: str | None = None):
    """Counts per symbol and window of the time at which the micro-batch ran.

    Update mode: a window's row is replaced while it is open.  The clock is its own
    watermark, so a window's state goes once a later micro-batch has run after it.
    """
    g = (trades.drop("event_time").withColumn("proc_time", F.current_timestamp()).withWatermark("proc_time", "0 seconds")
         .groupBy("symbol", F.window("proc_time", size).alias("w")).agg(F.count(F.lit(1)).alias("trade_count")))
    out = g.select("symbol", to_ntz("w.start").alias("window_start"), to_ntz("w.end").alias("window_end"), "trade_count")
    return _written(out, path, checkpoint, "update", trigger)


def read_process_time_windows(spark: SparkSession, path: str) -> DataFrame:
    return _latest(spark, path, ["symbol", "window_start"])


def sliding_by_panes(trades: DataFrame, size: str, slide: str) -> DataFrame:
    """Counts and summed quantity per symbol and sliding window of a watermarked stream, append mode.

    Two chained aggregates: per slide-wide pane, then over the panes of a window;
    ``size`` must be a whole number of slides.
    """
    panes = trades.groupBy("symbol", F.window("event_time", slide).alias("pane")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("qty").alias("q"))
    panes = panes.select("symbol", F.window_time("pane").alias("pane_time"), "n", "q")
    g = panes.groupBy("symbol", F.window("pane_time", size, slide).alias("w")).agg(F.sum("n").alias("trade_count"), F.sum("q").alias("total_qty"))
    return g.select("symbol", to_ntz("w.start").alias("window_start"), to_ntz("w.end").alias("window_end"), "trade_count", "total_qty")


def stream_sliding(trades: DataFrame, path: str, checkpoint: str, size: str = "2 minutes", slide: str = "1 minute", trigger: str | None = None):
    w = (sliding_by_panes(trades, size, slide).writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return run(w, trigger)


# ---------------------------------------------------------------- sessions by panes
_EXACT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _part_type(column: str) -> str:
    return WIDE if column.endswith("_dec") else "double" if column.endswith("_dbl") else "long"


class SessionsOfPanes(StatefulProcessor):
    """Joins the closed panes of a bucket's keys to sessions; a key's last session stays open until the pane after its last one has closed too.

    The state has the bucket's open sessions, a timer stands at the first time one of
    them closes.  Sums of doubles are text here and in the state, as pandas takes NaN for NULL.
    """

    def __init__(self, gap_us: int, parts: list[str]):
        self.gap_us, self.columns = gap_us, ["text_key", "lo", "hi", "event_count", *parts]  # pandas renames columns that begin with _
        self.texts = [c.endswith("_dbl") for c in self.columns]
        self.schema = ", ".join(f"`{c}` {'string' if c == 'text_key' or text else _part_type(c)}" for c, text in zip(self.columns, self.texts))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", self.schema)

    def _due(self, session: tuple) -> int:
        """Two rows of one session lie in the same or in neighbouring panes: past the next pane's end nothing can join."""
        return -(-(session[2] // self.gap_us + 2) * self.gap_us // 1000)

    def _sums(self, a: tuple, b: tuple) -> list:
        return [y if x is None else x if y is None else repr(float(x) + float(y)) if text else x + y
                for x, y, text in zip(a[3:], b[3:], self.texts[3:])]

    def _sessions(self, panes: list[tuple]) -> Iterator[tuple]:
        """The sessions of one key, in order of time."""
        current = None
        for pane in sorted(panes, key=lambda p: p[1]):
            if current and pane[1] - current[2] <= self.gap_us:
                current = (*current[:2], pane[2], *self._sums(current, pane))
            else:
                if current:
                    yield current
                current = pane
        yield current

    def _held(self) -> list[tuple]:
        return [tuple(r) for r in self.open.get()] if self.open.exists() else []

    def _keep(self, sessions: list[tuple]) -> None:
        if sessions:
            self.open.put(sessions)
            self.handle.registerTimer(min(map(self._due, sessions)))
        else:
            self.open.clear()

    def _out(self, sessions: list[tuple]) -> Iterator[pd.DataFrame]:
        if sessions:
            yield pd.DataFrame(sessions, columns=self.columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        panes, done, still, passed = {}, [], [], timerValues.getCurrentWatermarkInMs()
        held = self._held()
        if held:
            self.handle.deleteTimer(min(map(self._due, held)))
        for part in rows:
            columns = [part[c].astype(object).where(part[c].notna(), None) if c in self.columns[4:] else part[c] for c in self.columns]
            for pane in zip(*(c.tolist() for c in columns)):
                panes.setdefault(pane[0], []).append(pane)
        for session in held:
            panes.setdefault(session[0], []).append(session)
        with localcontext(Context(prec=38)):
            for own in panes.values():
                *closed, last = self._sessions(own)
                done += closed
                (done if self._due(last) <= passed else still).append(last)
        self._keep(still)
        yield from self._out(done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, passed = self._held(), timerValues.getCurrentWatermarkInMs()
        self._keep([s for s in held if self._due(s) > passed])
        yield from self._out([s for s in held if self._due(s) <= passed])

    def close(self) -> None:
        pass


def session_panes(events: DataFrame, keys: list[str], time_col: str, gap: str, sum_cols: tuple[str, ...] = ()) -> DataFrame:
    """First and last time, count and sums per key and pane one gap wide, of a watermarked stream."""
    panes = events.groupBy(*keys, F.window(time_col, gap).alias("_pane")).agg(
        F.min(F.unix_micros(time_col)).alias("_lo"), F.max(F.unix_micros(time_col)).alias("_hi"),
        F.count(F.lit(1)).alias("event_count"), *[p for c in sum_cols for p in sum_parts(c, c)])
    return panes.select(*keys, F.window_time("_pane").alias("_pane_time"), "_lo", "_hi", "event_count",
                        *[p for c in sum_cols for p in part_names(c)])


def stream_sessions_by_panes(events: DataFrame, keys: list[str], time_col: str, path: str, checkpoint: str, gap: str = "5 minutes",
                             trigger: str | None = None, sum_cols: tuple[str, ...] = (), buckets: int = 256):
    """Sessions of a watermarked stream, under ``path/batch_id=N``: keys, session_start, session_end, event_count, sums.

    The same sessions as ``stream_sessions``; rows exactly one gap apart stay
    together.  A session is written once the watermark has passed the end of the
    pane after its last one, at most two gaps after its last row.  The rows are reduced
    by (key, pane) before and after the shuffle; the keys are dealt over ``buckets``
    states, each of which takes one row for each pane of its keys and holds their open
    sessions, so many small keys cost no call each.  NULL keys are a key, rows without
    a time are left out.
    """
    spark = events.sparkSession
    gap_us = interval_micros(gap)
    panes = session_panes(events, keys, time_col, gap, sum_cols)
    parts = {p: q for i, c in enumerate(sum_cols) for p, q in zip(part_names(c), part_names(f"sum{i}"))}
    processor = SessionsOfPanes(gap_us, [*parts.values()])
    as_text = {"timestampFormat": _EXACT_TIME + "XXX", "timestampNTZFormat": _EXACT_TIME}  # of any type, equal for equal keys
    dealt = panes.select(F.pmod(F.hash(*keys), F.lit(buckets)).alias("bucket"), "_pane_time", F.to_json(F.struct(*keys), as_text).alias("text_key"),
                         F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), "event_count",
                         *[(F.col(p).cast("string") if q.endswith("_dbl") else F.col(p)).alias(q) for p, q in parts.items()])
    found = (dealt.groupBy("bucket").transformWithStateInPandas(processor, processor.schema, "Append", "EventTime")
             .withColumn("key", F.from_json("text_key", panes.select(*keys).schema, as_text))
             .withColumns({q: F.col(q).cast("double") for q in parts.values() if q.endswith("_dbl")}))
    out = found.select(*[F.col("key").getField(k).alias(k) for k in keys], to_ntz(F.timestamp_micros("lo")).alias("session_start"),
                       to_ntz(F.timestamp_micros(F.col("hi") + gap_us)).alias("session_end"), "event_count",
                       *[finish_sum(f"sum{i}").alias(c) for i, c in enumerate(sum_cols)])
    with rocksdb(spark):
        return _written(out, path, checkpoint, "append", trigger)


# ---------------------------------------------------------------- keyed raw table, observed counts
def stream_keyed_raw(trades: DataFrame, keys: list[str], path: str, checkpoint: str, delay: str = "1 hour", trigger: str | None = None):
    """The raw table with its key kept by state: a row whose key came within ``delay`` of event time is not written again.

    State is dropped as the watermark passes; a replay from before the watermark is
    late and adds nothing either.
    """
    once = trades.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(keys)
    w = once.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return run(w, trigger)


def observed_growth(spark: SparkSession, queries: list) -> DataFrame:
    """batch_id, rows, total, growing for each micro-batch that ran, from metrics observed by the queries (``observe_rows``).

    One row a micro-batch of the queries given (runs of one checkpoint, in order);
    a micro-batch that brought nothing is a row that does not grow.
    """
    rows, total = {}, 0
    for q in queries:
        for p in q.recentProgress:
            seen = p["observedMetrics"].get("rows")
            if seen is not None:
                rows[p["batchId"]] = seen["n"]
    out = []
    for b, n in sorted(rows.items()):
        total += n
        out.append((b, n, total, n > 0))
    return spark.createDataFrame(out, "batch_id long, rows long, total long, growing boolean")


def observe_rows(df: DataFrame) -> DataFrame:
    return df.observe("rows", F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- helpers
def _written(df: DataFrame, path: str, checkpoint: str, mode: str, trigger: str | None):
    def write_batch(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return run(df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).outputMode(mode), trigger)


def _latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The row of each key from the last micro-batch that wrote one."""
    rows = spark.read.option("basePath", path).parquet(path)
    kept = [c for c in rows.columns if c not in (*keys, "batch_id")]
    last = rows.groupBy(*keys).agg(F.max(F.struct("batch_id", *kept)).alias("last"))
    return last.select(*keys, *[F.col("last").getField(c).alias(c) for c in kept])
