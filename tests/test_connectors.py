"""Connector option builders (the jars are not in this environment)."""

import pytest

from tidemark.sources.kafka import kafka_sink_options, kafka_source_options
from tidemark.sources.objects import s3a_options


def test_kafka_source_options():
    o = kafka_source_options("trades", "broker:9092", "earliest", "g1", 1000)
    assert o["subscribe"] == "trades" and o["startingOffsets"] == "earliest"
    assert o["kafka.bootstrap.servers"] == "broker:9092" and o["kafka.group.id"] == "g1"
    assert o["maxOffsetsPerTrigger"] == "1000"
    assert kafka_source_options("t", "b", "latest")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka_source_options("t", "b", "middle")


def test_kafka_sink_options():
    o = kafka_sink_options("trades", "b:1")
    assert o["kafka.acks"] == "all" and o["topic"] == "trades"


def test_s3a_options():
    o = s3a_options("http://store:9000", "ak", "sk")
    assert o["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert o["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert o["spark.hadoop.fs.s3a.access.key"] == "ak"
