"""Event-time helpers: epoch milliseconds, computed time columns, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_millis(ts) -> Column:
    """Epoch milliseconds of a timestamp (floor), for LTZ or NTZ input.

    NTZ values are read as UTC wall-clock (the session zone is UTC).
    """
    return F.unix_millis(_c(ts).cast("timestamp"))


def event_time(ts_ms="ts") -> Column:
    """``TO_TIMESTAMP_LTZ(ts, 3)``: epoch milliseconds to a timestamp."""
    return F.timestamp_millis(_c(ts_ms))


def with_event_time(df: DataFrame, ts_ms: str = "ts", out: str = "event_time") -> DataFrame:
    return df.withColumn(out, event_time(ts_ms))


def with_proc_time(df: DataFrame, out: str = "proc_time") -> DataFrame:
    """``PROCTIME()``: one wall-clock value per query (per micro-batch)."""
    return df.withColumn(out, F.current_timestamp())


def to_ntz(col) -> Column:
    """Zone-free output timestamp (the bar tables declare TIMESTAMP(3) without zone)."""
    return _c(col).cast("timestamp_ntz")


def clock_label(ts_ms="ts") -> Column:
    """Epoch milliseconds as an ``HH:mm:ss`` wall-clock label (UTC)."""
    return F.date_format(F.timestamp_millis(_c(ts_ms)), "HH:mm:ss")


def interval_micros(interval: str) -> int:
    """Length of "5 minutes" and the like in microseconds."""
    n, unit = interval.split()
    unit = unit.rstrip("s").lower()
    scale = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
             "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}[unit]
    return int(float(n) * scale)
