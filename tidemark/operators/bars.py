"""Windowed trade aggregates: OHLCV bars, window statistics, sliding windows.

All of them are one ``groupBy(symbol, window(...))``: Catalyst plans a
partial aggregate before the shuffle and a final one after it, so the
exchange carries one row per (symbol, window) per input partition, never
raw trades.  A hot symbol is spread over its windows, so no single group
holds a large share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import exact_avg, exact_sum, finish_sum, merge_parts, sum_parts
from ..functions.ordering import first_value, last_value
from ..functions.time import interval_micros, to_ntz
from ..sources.trades import BUY, SELL

BAR_COLUMNS = ["symbol", "window_start", "window_end", "open_price", "high_price",
               "low_price", "close_price", "total_qty", "trade_count", "buy_qty", "sell_qty"]


def _window(time_col: str, size: str, slide: str | None) -> Column:
    return F.window(time_col, size, slide) if slide else F.window(time_col, size)


def _windowed(trades: DataFrame, size: str, slide: str | None, time_col: str,
              keys: list[str], *aggs: Column) -> DataFrame:
    g = trades.groupBy(*keys, _window(time_col, size, slide).alias("w")).agg(*aggs)
    return g.select(*keys, to_ntz("w.start").alias("window_start"),
                    to_ntz("w.end").alias("window_end"),
                    *[c for c in g.columns if c not in keys and c != "w"])


def bar_aggregates() -> list[Column]:
    """The OHLCV aggregate list (usable in batch and streaming groupBy)."""
    return [
        first_value("price").alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        last_value("price").alias("close_price"),
        exact_sum("qty").alias("total_qty"),
        F.count(F.lit(1)).alias("trade_count"),
        exact_sum(F.when(F.col("side") == BUY, F.col("qty")).otherwise(F.lit(0.0))).alias("buy_qty"),
        exact_sum(F.when(F.col("side") == SELL, F.col("qty")).otherwise(F.lit(0.0))).alias("sell_qty"),
    ]


def ohlcv_bars(trades: DataFrame, size: str = "1 minute", slide: str | None = None,
               time_col: str = "event_time") -> DataFrame:
    """Open/high/low/close, volume, count and buy/sell volume per symbol and window.

    Windows are half-open and aligned to the epoch: 10:00:30 falls in
    [10:00, 10:01).  Rows with a NULL event time fall in no window.
    """
    return _windowed(trades, size, slide, time_col, ["symbol"], *bar_aggregates())


def window_stats(trades: DataFrame, size: str = "1 minute", slide: str | None = None,
                 time_col: str = "event_time") -> DataFrame:
    return _windowed(trades, size, slide, time_col, ["symbol"],
                     F.count(F.lit(1)).alias("trade_count"),
                     exact_sum("qty").alias("total_qty"),
                     exact_avg("price").alias("avg_price"))


def window_counts(trades: DataFrame, size: str = "1 minute", slide: str | None = None,
                  time_col: str = "event_time") -> DataFrame:
    return _windowed(trades, size, slide, time_col, ["symbol"],
                     F.count(F.lit(1)).alias("trade_count"))


def _panes(trades: DataFrame, size: str, slide: str, time_col: str, partial: list[Column],
           merged: list[Column]) -> DataFrame:
    """Overlapping windows from slide-wide panes: rows are first reduced to one
    per (symbol, pane), and only panes are copied into their size/slide windows.
    Exact for counts and sums where the size is a whole number of slides."""
    panes = (trades.groupBy("symbol", F.window(time_col, slide).alias("_pane")).agg(*partial)
             .withColumn("_start", F.col("_pane.start")).drop("_pane"))
    return _windowed(panes, size, slide, "_start", ["symbol"], *merged)


def _whole_slides(trades: DataFrame, size: str, slide: str) -> bool:
    return not trades.isStreaming and interval_micros(size) % interval_micros(slide) == 0


def sliding_counts(trades: DataFrame, size: str = "2 minutes", slide: str = "1 minute",
                   time_col: str = "event_time") -> DataFrame:
    """HOP window: every row falls in size/slide overlapping windows.

    Note the argument order: a SQL HOP table function takes (slide, size), Spark's
    ``window`` takes (size, slide).
    """
    if not _whole_slides(trades, size, slide):
        return window_counts(trades, size, slide, time_col)
    return _panes(trades, size, slide, time_col, [F.count(F.lit(1)).alias("n")], [F.sum("n").alias("trade_count")])


def moving_average(trades: DataFrame, size: str = "5 minutes", slide: str = "1 minute",
                   time_col: str = "event_time") -> DataFrame:
    """Average price over the last ``size``, emitted every ``slide``."""
    if not _whole_slides(trades, size, slide):
        return _windowed(trades, size, slide, time_col, ["symbol"],
                         exact_avg("price").alias("avg_price"),
                         F.count(F.lit(1)).alias("trade_count"))
    out = _panes(trades, size, slide, time_col,
                 [*sum_parts("price", "price"), F.count("price").alias("priced"), F.count(F.lit(1)).alias("n")],
                 [*merge_parts("price"), F.sum("priced").alias("priced"), F.sum("n").alias("trade_count")])
    return out.select("symbol", "window_start", "window_end",
                      F.when(F.col("priced") > 0, finish_sum("price") / F.col("priced")).alias("avg_price"),
                      "trade_count")


def buy_pressure(bars: DataFrame) -> DataFrame:
    """Buy share of volume per bar, only where buy + sell volume is positive."""
    return (bars.where(F.col("buy_qty") + F.col("sell_qty") > 0)
            .select("symbol", "window_start", "buy_qty", "sell_qty",
                    ((F.col("buy_qty") / (F.col("buy_qty") + F.col("sell_qty"))) * 100)
                    .alias("buy_pct")))
