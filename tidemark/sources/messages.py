"""Keyed JSON trade messages: parse (lenient or strict), envelope, write.

A message row is the Kafka source shape: key, value (both text here),
partition, offset.  Parsing keeps the envelope so ``offset`` becomes the
trade's ``seq``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import event_time
from ..plans.layout import bucket_of
from .trades import TRADE_COLUMNS, TRADE_SCHEMA

CORRUPT = "_corrupt"
_PARSE_SCHEMA = T.StructType(TRADE_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])


def parse_trades(messages: DataFrame, value_col: str = "value", mode: str = "lenient") -> DataFrame:
    """JSON text -> trade columns, keeping every envelope column.

    lenient: malformed text, wrong-typed fields and arrays are marked in
    ``_corrupt``; empty text, NULL and objects without any trade field come
    back all-NULL.  Both kinds get ``quarantined = true``.  Rows with only
    some fields missing are kept (missing fields are NULL).
    strict: the first message that lenient parsing would quarantine fails the
    query: malformed text by FAILFAST, empty, NULL or fieldless text by its own
    check.  ``quarantined`` is there too, always false.
    """
    if mode == "strict":
        parsed = messages.withColumn(
            "_m", F.from_json(F.col(value_col).cast("string"), TRADE_SCHEMA, {"mode": "FAILFAST"}))
        empty: Column = reduce(lambda a, b: a & b, [F.col(f"_m.{c}").isNull() for c in TRADE_COLUMNS])
        return parsed.select(*messages.columns, *[F.col(f"_m.{c}").alias(c) for c in TRADE_COLUMNS],
                             F.when(empty, F.raise_error(F.lit("message without a trade")).cast("boolean"))
                             .otherwise(F.lit(False)).alias("quarantined"))
    if mode != "lenient":
        raise ValueError(f"mode must be 'lenient' or 'strict', not {mode!r}")
    parsed = messages.withColumn(
        "_m", F.from_json(F.col(value_col).cast("string"), _PARSE_SCHEMA,
                          {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    all_null: Column = reduce(lambda a, b: a & b, [F.col(f"_m.{c}").isNull() for c in TRADE_COLUMNS])
    return parsed.select(
        *messages.columns,
        *[F.col(f"_m.{c}").alias(c) for c in TRADE_COLUMNS],
        (F.col(f"_m.{CORRUPT}").isNotNull() | all_null).alias("quarantined"))


def good_trades(parsed: DataFrame, seq_col: str = "offset") -> DataFrame:
    """Accepted rows as trades (seq = source offset, event_time from ts)."""
    return (parsed.where(~F.col("quarantined"))
            .select(*TRADE_COLUMNS, F.col(seq_col).alias("seq"))
            .withColumn("event_time", event_time("ts")))


def quarantine(parsed: DataFrame) -> DataFrame:
    """Rejected messages with their envelope, for inspection or replay."""
    keep = [c for c in ("partition", "offset", "key") if c in parsed.columns]
    return parsed.where(F.col("quarantined")).select(*keep, "value")


def partition_for(key: Column, n: int) -> Column:
    """Deterministic partition of a message key: first 32 bits of md5 mod n.

    A stand-in for a producer's partitioner (not Kafka's murmur2); one key
    always maps to one partition, and the rule is reproducible in SQL.
    """
    return bucket_of(key, n)


def to_messages(trades: DataFrame, key_col: str = "symbol", partitions: int = 3,
                offset_col: str | None = "seq") -> DataFrame:
    """Trades -> (partition, offset, key, value): JSON value, key NULL if empty."""
    key = F.nullif(F.col(key_col).cast("string"), F.lit(""))
    value = F.to_json(F.struct(*[F.col(c) for c in TRADE_COLUMNS]))
    cols = [partition_for(F.coalesce(key, value), partitions).alias("partition")]
    if offset_col:
        cols.append(F.col(offset_col).alias("offset"))
    return trades.select(*cols, key.alias("key"), value.alias("value"))


def message_envelope(raw: DataFrame) -> DataFrame:
    """Expose a source row's partition, offset, key and value as text."""
    return raw.select("partition", "offset", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"))


def round_trade(trades: DataFrame) -> DataFrame:
    """Price to 2 decimals, quantity to 4 (the producer's precision)."""
    return trades.withColumn("price", F.round("price", 2)).withColumn("qty", F.round("qty", 4))
