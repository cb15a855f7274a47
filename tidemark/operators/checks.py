"""Data checks over stored trades and bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import exact_sum


def reconcile_bars(log: DataFrame, bars: DataFrame) -> DataFrame:
    """Per symbol: trades and volume in the log vs. the sums over its bars.

    Both sides are aggregated to one row per symbol before the full outer
    join, so the join moves a handful of rows whatever the data size.  Volumes
    agree when they differ by no more than the rounding of the bar totals
    (relative 1e-9).
    """
    l = log.groupBy("symbol").agg(F.count(F.lit(1)).alias("log_count"), exact_sum("qty").alias("log_qty"))
    b = bars.groupBy("symbol").agg(F.sum("trade_count").alias("bar_count"),
                                   exact_sum("total_qty").alias("bar_qty"))
    b = b.withColumnRenamed("symbol", "b_symbol")  # a NULL symbol is a symbol like others
    j = l.join(b, F.col("symbol").eqNullSafe(F.col("b_symbol")), "full_outer").select(
        F.coalesce("symbol", "b_symbol").alias("symbol"), "log_count", "log_qty", "bar_count", "bar_qty")
    return j.withColumn("consistent", F.col("log_count").eqNullSafe(F.col("bar_count"))
                        & (F.col("log_qty").eqNullSafe(F.col("bar_qty"))
                           | F.coalesce(F.abs(F.col("log_qty") - F.col("bar_qty")) <= 1e-9 * F.abs("log_qty"), F.lit(False))))
