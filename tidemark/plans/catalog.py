"""Databases and tables in Spark's catalog, with the trade table schemas.

Tables are external Parquet tables whose location is under a folder the
caller chooses (on a cluster: the shared folder), never the driver's
working directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RAW_TRADES_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("qty", T.DoubleType()),
    T.StructField("side", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
])

AGG_1M_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("open_price", T.DoubleType()),
    T.StructField("high_price", T.DoubleType()),
    T.StructField("low_price", T.DoubleType()),
    T.StructField("close_price", T.DoubleType()),
    T.StructField("total_qty", T.DoubleType()),
    T.StructField("trade_count", T.LongType()),
    T.StructField("buy_qty", T.DoubleType()),
    T.StructField("sell_qty", T.DoubleType()),
])

SAMPLE_TRADES_SCHEMA = T.StructType([
    T.StructField("trade_id", T.LongType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("trade_time", T.TimestampType()),
])

# Declared (not enforced) keys of the tables above.
KEYS = {"raw_trades": ["symbol", "ts"], "agg_1m": ["symbol", "window_start"],
        "sample_trades": ["trade_id"]}


def ensure_database(spark: SparkSession, name: str, location: str | None = None, use: bool = True) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")
    if use:
        spark.catalog.setCurrentDatabase(name)


def create_table_if_missing(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def insert(df: DataFrame, name: str, schema: T.StructType) -> None:
    """Append rows to a table, matching its declared columns by name."""
    df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]).write.insertInto(name)
