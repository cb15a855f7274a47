"""The trade model and its derivation from the ``events`` table.

A trade message carries symbol, ts (epoch ms), price, qty and side.  Every
stored trade also keeps ``seq``, the position of the message in its source
(the Kafka offset, or the event id when replaying stored events), which
breaks ties between trades of one symbol in one millisecond.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import epoch_millis, event_time
from .tables import load_table

# The wire schema of one trade message (all fields nullable: lenient input).
TRADE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("qty", T.DoubleType()),
    T.StructField("side", T.StringType()),
])

TRADE_COLUMNS = [f.name for f in TRADE_SCHEMA.fields]

# The two sides a trade message may carry.
BUY = "BUY"
SELL = "SELL"


def trades_from_events(events: DataFrame) -> DataFrame:
    """Map the ``events`` table onto trades.

    symbol = event_type, ts = epoch ms of ts, price = value,
    qty = props.k, side = BUY for even user ids else SELL, seq = event_id.
    """
    return events.select(
        F.col("event_type").alias("symbol"),
        epoch_millis("ts").alias("ts"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("qty"),
        F.when(F.col("user_id") % 2 == 0, F.lit(BUY)).otherwise(F.lit(SELL)).alias("side"),
        F.col("event_id").alias("seq"),
    ).withColumn("event_time", event_time("ts"))


def load_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_events(load_table(spark, sf_dir, "events"))


def project_trades(trades: DataFrame) -> DataFrame:
    """The raw-trade projection (column list of the raw table)."""
    return trades.select("symbol", "ts", "price", "qty", "side", "event_time")


# The same mapping as DuckDB SQL, for the oracle side of every query.
TRADES_SQL = """
trades AS (
  SELECT event_type AS symbol,
         epoch_us(ts) // 1000 AS ts,
         value AS price,
         CAST(props ->> '$.k' AS DOUBLE) AS qty,
         CASE WHEN user_id % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side,
         event_id AS seq,
         make_timestamp((epoch_us(ts) // 1000) * 1000) AS event_time
  FROM events
)"""
