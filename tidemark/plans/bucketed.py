"""Keyed tables stored in buckets of their key, so that an upsert moves only its updates.

The table is bucketed and sorted by its key, one file a bucket.  A merge joins
it with the new rows on that key: the stored side is read bucket by bucket
where it lies, the updates alone are shuffled into the same number of buckets,
and each task writes the bucket it has joined.  The result is a new table
beside the old one (readers of the old one are not disturbed); the caller
goes on with the new name and drops the old table when nobody reads it.

Key columns are NOT NULL, as in a declared primary key: a NULL key fails the
write.  The newest row by (ts, seq) wins, whichever side it is on, so late and
replayed updates change nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordering import order_key
from ..operators.upsert import row_hash, upsert_by_key


def _required(df: DataFrame, keys: list[str]) -> DataFrame:
    for k in keys:
        df = df.withColumn(k, F.when(F.col(k).isNull(), F.raise_error(F.lit(f"key column {k} is NULL"))).otherwise(F.col(k)))
    return df


def _save(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> None:
    (df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).mode("errorifexists").saveAsTable(name))


def create_bucketed(rows: DataFrame, name: str, path: str, keys: list[str], buckets: int,
                    ts: str | Column = "ts", seq: str | Column = "seq") -> None:
    """The latest row of each key as table ``name`` of ``buckets`` files under ``path``."""
    latest = upsert_by_key(_required(rows, keys), keys, ts, seq).select(*rows.columns)
    _save(latest.repartition(buckets, *keys), name, path, keys, buckets)


def open_bucketed(spark: SparkSession, name: str, path: str, schema: T.StructType, keys: list[str], buckets: int) -> None:
    """Declare a bucketed table that another session has written."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")


def merged_rows(stored: DataFrame, updates: DataFrame, keys: list[str], buckets: int | None = None,
                ts: str | Column = "ts", seq: str | Column = "seq") -> DataFrame:
    """The table after the updates: the newest row of each key of either side.

    An order key that is NULL is older than any other; of equal ones the row with
    the greater hash stays, as in ``upsert_by_key``, so the sides can be swapped.
    """
    rest = [c for c in stored.columns if c not in keys]

    def side(df: DataFrame, tag: str) -> DataFrame:
        order = F.struct(order_key(ts, seq).alias("o"), row_hash(df, rest).alias("h"))
        return df.select(*[F.col(k).alias(f"{tag}_{k}") for k in keys], F.struct(*rest).alias(f"{tag}_row"), order.alias(f"{tag}_order"))

    new = upsert_by_key(_required(updates.select(*stored.columns), keys), keys, ts, seq).select(*stored.columns)
    if buckets:  # left to itself, the join takes the partitions of the aggregate and shuffles the stored side to them
        new = new.repartition(buckets, *keys)
    same = reduce(lambda x, y: x & y, [F.col(f"_n_{k}") == F.col(f"_o_{k}") for k in keys])
    both = side(stored, "_o").join(side(new, "_n"), same, "full_outer")
    newer = F.col("_o_row").isNull() | (F.col("_n_order") > F.col("_o_order"))
    kept = both.select(*[F.coalesce(f"_o_{k}", f"_n_{k}").alias(k) for k in keys],
                       F.when(newer, F.col("_n_row")).otherwise(F.col("_o_row")).alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in stored.columns])


def merge_bucketed(spark: SparkSession, name: str, updates: DataFrame, into: str, path: str, keys: list[str], buckets: int,
                   ts: str | Column = "ts", seq: str | Column = "seq") -> None:
    """Upsert ``updates`` into table ``name``; the outcome is table ``into``, bucketed alike."""
    _save(merged_rows(spark.table(name), updates, keys, buckets, ts, seq), into, path, keys, buckets)
