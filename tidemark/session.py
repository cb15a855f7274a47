"""Session construction and shared-folder lookup.

All jobs run with the session time zone fixed to UTC so that epoch
milliseconds, window bounds and ``timestamp_ntz`` outputs agree on every
executor and with the DuckDB oracle.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tidemark job relies on.  AQE re-plans shuffles at runtime
# (coalescing small partitions, splitting skewed ones); the broadcast
# threshold stays at Spark's size-checked default so only sides whose
# measured size is under it are ever broadcast.  Arrow batches to Python are
# bounded by bytes, not only by rows, so long texts don't fill a worker.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "true",
}


# Settings for a large cluster (100 TB input, ~1000 executors).  Shuffle
# partitions start high and AQE coalesces them to ~256 MB; scans split at
# 512 MB; skewed join partitions over 256 MB and 5x the median are split.
# The broadcast threshold is explicit: only sides measured under it are
# broadcast (AQE uses runtime sizes).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

ROCKSDB_STATE = {"spark.sql.streaming.stateStore.providerClass":
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, rocksdb_state: bool = False,
                cluster: bool = False) -> SparkSession:
    """``rocksdb_state`` keeps streaming state off the JVM heap: use it when
    keyed state is large (sessions over many users).  For bar state
    (symbols x open windows) the default in-memory store measured faster.
    It must be chosen before a query's first run; a checkpoint keeps it."""
    builder = SparkSession.builder.appName(app)
    if cluster:
        for k, v in CLUSTER_CONF.items():
            builder = builder.config(k, v)
    if rocksdb_state:
        for k, v in ROCKSDB_STATE.items():
            builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k, v in BASE_CONF.items():
        if spark.conf.isModifiable(k):  # a foreign session keeps its static settings
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none (local tests) is a private folder created
    and registered, so executors and the driver agree on one location.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a SparkContext (Spark Connect)
        sc = None
    d = sc.getCheckpointDir() if sc is not None else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if sc is None or not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
        else:
            spark.conf.set("spark.checkpoint.dir", d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one job's outputs."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
