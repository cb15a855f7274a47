"""Latest row per key (upsert on read) and the unenforced-key check.

``max_by(struct(row), order_key)`` is an aggregate, so Spark combines rows
on the map side before the shuffle: a key holding a third of all rows is
reduced to one row per input partition before it reaches its reducer.  A
``row_number()`` window would instead ship every row of the hot key to one
task and sort it there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordering import order_key


def upsert_by_key(df: DataFrame, keys: list[str], ts: str | Column = "ts",
                  seq: str | Column = "seq") -> DataFrame:
    """Newest row wins per key; order is (ts, seq), a total order.

    A row whose order key is NULL is older than any other; of several such rows
    the one with the greatest hash stays, the same in every run.  The hash tells
    apart which columns are NULL; columns may have any type, maps included.
    """
    rest = [c for c in df.columns if c not in keys]
    latest = (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*rest), F.struct(order_key(ts, seq).alias("o"), row_hash(df, rest).alias("h"))).alias("_row")))
    return latest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """A 64-bit hash of the row's columns in which a NULL counts by its place; nested columns count as JSON text."""
    parts = [F.lit(0)]
    for c in columns:
        nested = isinstance(df.schema[c].dataType, (T.MapType, T.ArrayType, T.StructType))
        value = F.to_json(F.struct(F.col(f"`{c}`").alias("c")), {"ignoreNullFields": "false"}) if nested else F.col(f"`{c}`")
        parts += [F.col(f"`{c}`").isNull(), value]
    return F.xxhash64(*parts)


def check_unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys declared but not enforced: report keys carried by more than one row."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))
