"""Rows and batches that must not be lost."""

import pytest

from tidemark.operators.checks import reconcile_bars
from tidemark.operators.upsert import upsert_by_key
from tidemark.plans.versioned import VersionedTable
from tidemark.sources.kafka import kafka_source_options
from tidemark.streaming.jobs import stream_to_versioned


def test_null_order_key_keeps_its_row(spark):
    df = spark.createDataFrame([("A", None, None, 1.0), ("B", None, 1, 2.0), ("B", 5, 2, 3.0)], "symbol string, ts long, seq long, qty double")
    assert sorted(map(tuple, upsert_by_key(df, ["symbol"]).select("symbol", "qty").collect())) == [("A", 1.0), ("B", 3.0)]


def test_null_symbol_reconciles(spark):
    log = spark.createDataFrame([(None, 1.0), ("A", 2.0)], "symbol string, qty double")
    bars = spark.createDataFrame([(None, 1, 1.0), ("A", 1, 2.0)], "symbol string, trade_count long, total_qty double")
    rows = reconcile_bars(log, bars).collect()
    assert len(rows) == 2 and all(r["consistent"] for r in rows)


def test_data_loss_fails_unless_asked():
    assert kafka_source_options("t", "s")["failOnDataLoss"] == "true"
    assert kafka_source_options("t", "s", fail_on_data_loss=False)["failOnDataLoss"] == "false"


def test_unreadable_log_is_not_empty(spark, tmp_root, monkeypatch):
    table = VersionedTable(spark, f"{tmp_root}/bad", keys=["symbol"])
    assert table.commits().count() == 0
    table.log_path = "nosuchscheme://x/_commits"
    with pytest.raises(Exception):
        table.commits().count()


def test_second_checkpoint_commits_its_rows(spark, tmp_root):
    schema = "symbol string, ts long, seq long"
    for name in ("a", "b"):
        spark.createDataFrame([(name, 1, 1)], schema).write.parquet(f"{tmp_root}/in-{name}")
    table = VersionedTable(spark, f"{tmp_root}/t", keys=["symbol"])
    for name in ("a", "b"):
        stream = spark.readStream.schema(schema).parquet(f"{tmp_root}/in-{name}")
        q = stream_to_versioned(stream, table, f"{tmp_root}/ck-{name}", "s")
        if q is not None and q.isActive:
            q.processAllAvailable()
            q.stop()
    table.refresh()
    assert sorted(r["symbol"] for r in table.snapshot().collect()) == ["a", "b"]
