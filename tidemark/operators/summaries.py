"""Ad-hoc queries over stored trades and bars: counts, summaries, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import exact_avg, exact_sum


def count_rows(df: DataFrame, alias: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def symbol_summary(trades: DataFrame) -> DataFrame:
    return trades.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("trade_count"),
        exact_sum("qty").alias("total_volume"),
        exact_avg("price").alias("avg_price"))


def side_summary(trades: DataFrame) -> DataFrame:
    return trades.groupBy("side").agg(
        F.count(F.lit(1)).alias("trade_count"),
        exact_sum("qty").alias("total_volume"))


def recent_trades(trades: DataFrame, n: int = 10) -> DataFrame:
    """Newest n trades; ``seq`` breaks ties so the answer is unique.

    Plans as TakeOrderedAndProject: a per-partition top-n, then a merge of
    n rows per partition, so no full sort and no large shuffle.
    """
    return trades.orderBy(F.col("ts").desc(), F.col("seq").desc()).limit(n)


def recent_bars(bars: DataFrame, n: int = 10, columns: list[str] | None = None) -> DataFrame:
    out = bars.orderBy(F.col("window_start").desc(), F.col("symbol").asc()).limit(n)
    return out.select(*columns) if columns else out


def top_buy_pressure(pressure: DataFrame, n: int = 10) -> DataFrame:
    return pressure.orderBy(F.col("window_start").desc(), F.col("symbol").asc()).limit(n)


# Amount bands of the labelling example (upper bounds, exclusive).
LOW_BELOW = 33
MEDIUM_BELOW = 66


def label_rows(rows: DataFrame) -> DataFrame:
    """id, upper-cased name, amount rounded to 1 decimal, LOW/MEDIUM/HIGH band."""
    return rows.select(
        "id",
        F.upper("name").alias("name_upper"),
        F.round("amount", 1).alias("amount_rounded"),
        F.when(F.col("amount") < LOW_BELOW, "LOW")
         .when(F.col("amount") < MEDIUM_BELOW, "MEDIUM")
         .otherwise("HIGH").alias("category"))


def filter_amount(rows: DataFrame, threshold: float = 50) -> DataFrame:
    return rows.where(F.col("amount") > threshold).select("id", "name", "amount")


def time_slice(df: DataFrame, start, end, time_col: str = "event_time") -> DataFrame:
    """Half-open range ``start <= t < end``; pushed to the Parquet scan."""
    c = F.col(time_col)
    return df.where((c >= F.lit(start)) & (c < F.lit(end)))


def peek(df: DataFrame, n: int = 5) -> DataFrame:
    """Any n rows (no order): a bounded look at a table or stream."""
    return df.limit(n)
