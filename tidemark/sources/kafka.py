"""Kafka topic as a trade stream or a bounded batch, and the keyed writer.

The Kafka connector jar is not part of this environment, so these builders
are covered by option tests only; the same parsing runs in every test over
file-backed message streams (``streaming.jobs.message_stream``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..streaming.jobs import trade_stream
from .messages import good_trades, message_envelope, parse_trades

# The start positions a trade stream may begin from, as Spark names them.
STARTING_OFFSETS = {"earliest": "earliest", "latest": "latest"}


def kafka_source_options(topic: str, servers: str, start: str = "earliest",
                         group_id: str | None = None, max_offsets_per_trigger: int | None = None,
                         extra: dict | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    if start not in STARTING_OFFSETS:
        raise ValueError(f"start must be one of {sorted(STARTING_OFFSETS)}")
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": STARTING_OFFSETS[start], "failOnDataLoss": str(fail_on_data_loss).lower()}
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(extra or {})
    return opts


def read_trade_stream(spark: SparkSession, topic: str, servers: str, start: str = "earliest",
                      group_id: str | None = None, lateness: str | None = "5 seconds",
                      mode: str = "lenient", max_offsets_per_trigger: int | None = None,
                      fail_on_data_loss: bool = True) -> DataFrame:
    """Topic -> parsed trades with event time and watermark (streaming).

    Offsets that expired before they were read stop the query unless
    ``fail_on_data_loss`` is turned off.
    """
    raw = spark.readStream.format("kafka").options(
        **kafka_source_options(topic, servers, start, group_id, max_offsets_per_trigger,
                               fail_on_data_loss=fail_on_data_loss)).load()
    return trade_stream(message_envelope(raw), lateness, mode)


def read_trade_batch(spark: SparkSession, topic: str, servers: str, mode: str = "lenient") -> DataFrame:
    """Bounded read: everything from the earliest to the latest offset now."""
    raw = (spark.read.format("kafka")
           .options(**kafka_source_options(topic, servers, "earliest"))
           .option("endingOffsets", "latest").load())
    return good_trades(parse_trades(message_envelope(raw), mode=mode))


def kafka_sink_options(topic: str, servers: str, acks: str = "all", retries: int = 3) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic,
            "kafka.acks": acks, "kafka.retries": str(retries)}


def write_messages(messages: DataFrame, topic: str, servers: str) -> None:
    """Write (key, value) rows from ``messages.to_messages`` to a topic."""
    (messages.select("key", "value").write.format("kafka")
     .options(**kafka_sink_options(topic, servers)).save())
