"""Physical-plan properties that matter at scale."""

from pyspark.sql import functions as F

from conftest import SF01
from tidemark import operators as ops
from tidemark.plans import layout as lay
from tidemark.registry import QUERIES
from tidemark.sources.trades import load_trades


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_use_partial_hash_aggregation(spark):
    p = plan(ops.ohlcv_bars(load_trades(spark, SF01)))
    assert "SortAggregate" not in p
    assert p.count("HashAggregate") >= 2


def test_scan_reads_only_needed_columns(spark):
    df = ops.side_summary(load_trades(spark, SF01))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint,props:string>" in p or "struct<user_id:bigint,props:string>" in p


def test_time_slice_pushes_filters(spark):
    events = spark.read.parquet(f"{SF01}/events.parquet")
    df = ops.time_slice(events, "2024-01-10 00:00:00", "2024-01-12 00:00:00", "ts")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p


def test_pruned_read_prunes_partitions(spark, tmp_root):
    layout = [lay.days("ts")]
    lay.write_layout(spark.read.parquet(f"{SF01}/events.parquet"), tmp_root, layout)
    df = lay.pruned_read(spark, tmp_root, layout, "ts", "2024-01-10 00:00:00", "2024-01-12 00:00:00")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(ts_day" in p
    files = df.select(F.input_file_name()).distinct().count()
    assert files <= 3 * 8


def test_upsert_combines_before_shuffle(spark):
    p = plan(QUERIES["upsert_by_key"](spark, SF01))
    # partial aggregate on the map side, final after the exchange
    assert "partial_max_by" in p


def test_recent_trades_is_top_k(spark):
    p = plan(QUERIES["recent_trades"](spark, SF01))
    assert "TakeOrderedAndProject" in p


def test_cluster_settings_keep_results(spark):
    """The cluster preset only changes sizing, never answers."""
    from oracle_compare import compare, duck
    from tidemark.session import CLUSTER_CONF
    old = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        for k, v in CLUSTER_CONF.items():
            spark.conf.set(k, v)
        con = duck(SF01)
        for name in ("ohlcv_bars_1m", "sessions", "upsert_by_key", "snapshot_diff"):
            r = compare(spark, name, SF01, con)
            assert r["ok"], r
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
