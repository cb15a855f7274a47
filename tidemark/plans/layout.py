"""Derived partition layouts and reads that prune by them.

A layout is a list of ``Part(transform, source, name)``.  Time transforms
follow the usual table-format conventions: years/months/hours count whole
units since 1970-01-01 (ints), days is a date.  ``bucket`` and ``truncate``
hash or cut a column.

Spark prunes partitions only on predicates over the partition columns
themselves; a filter on ``ts`` alone lists every directory.  ``pruned_read``
therefore adds the derived predicate implied by the filter on the source
column (a range for time units, equality for buckets, a prefix for
truncate), and keeps the original filter so the answer is exact.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Part:
    transform: str          # years | months | days | hours | bucket | truncate | identity
    source: str
    name: str
    param: int | None = None  # bucket count or truncate width


def _ts(col: str) -> Column:
    return F.col(col).cast("timestamp")


def years(source: str, name: str | None = None) -> Part:
    return Part("years", source, name or f"{source}_year")


def months(source: str, name: str | None = None) -> Part:
    return Part("months", source, name or f"{source}_month")


def days(source: str, name: str | None = None) -> Part:
    return Part("days", source, name or f"{source}_day")


def hours(source: str, name: str | None = None) -> Part:
    return Part("hours", source, name or f"{source}_hour")


def bucket(n: int, source: str, name: str | None = None) -> Part:
    return Part("bucket", source, name or f"{source}_bucket", n)


def truncate(width: int, source: str, name: str | None = None) -> Part:
    return Part("truncate", source, name or f"{source}_trunc", width)


def bucket_of(col: Column, n: int) -> Column:
    """First 32 bits of md5(text of the value), mod n.

    Deterministic and reproducible in SQL; it is not the murmur3 bucket of
    other table formats.
    """
    return (F.conv(F.substring(F.md5(col.cast("string")), 1, 8), 16, 10).cast("long") % F.lit(n)).cast("int")


def transform_value(p: Part, col: Column | None = None) -> Column:
    c = col if col is not None else F.col(p.source)
    if p.transform == "years":
        return (F.year(c.cast("timestamp")) - 1970).cast("int")
    if p.transform == "months":
        return ((F.year(c.cast("timestamp")) - 1970) * 12 + F.month(c.cast("timestamp")) - 1).cast("int")
    if p.transform == "days":
        return F.to_date(c.cast("timestamp"))
    if p.transform == "hours":
        return F.floor(F.unix_seconds(c.cast("timestamp")) / 3600).cast("int")
    if p.transform == "bucket":
        return bucket_of(c, p.param)
    if p.transform == "truncate":  # integers; text columns are cut in with_layout
        return c - F.pmod(c, F.lit(p.param))
    if p.transform == "identity":
        return c
    raise ValueError(f"unknown transform {p.transform}")


def with_layout(df: DataFrame, layout: list[Part]) -> DataFrame:
    out = df
    for p in layout:
        col = F.col(p.source)
        if p.transform == "truncate" and dict(df.dtypes)[p.source] == "string":
            out = out.withColumn(p.name, F.substring(col, 1, p.param))
        else:
            out = out.withColumn(p.name, transform_value(p, col))
    return out


def write_layout(df: DataFrame, path: str, layout: list[Part], mode: str = "overwrite") -> None:
    """Rows are gathered by partition value first, so a partition gets few files
    rather than one from every task; AQE splits a partition value that holds
    too many rows for one task."""
    laid = with_layout(df, layout)
    (laid.hint("rebalance", *[F.col(p.name) for p in layout]).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*[p.name for p in layout]).parquet(path))


_FIXED_TYPES = {"years": T.IntegerType(), "months": T.IntegerType(), "hours": T.IntegerType(),
                "bucket": T.IntegerType(), "days": T.DateType()}


def read_layout(spark: SparkSession, path: str, layout: list[Part], schema: T.StructType | None = None) -> DataFrame:
    """Read a laid-out table with its partition columns in their declared types.

    Values in directory names are text; left to inference '007' would come
    back as the number 7.  A truncate or identity column has the type of its
    source.  Where an identity column is its own source, its type is in no
    file: give ``schema`` (by default such a column is text).
    """
    found = schema or spark.read.parquet(path).schema
    types = {f.name: f.dataType for f in found.fields}
    if schema is None:
        for p in layout:
            own = T.StringType() if p.name == p.source else types[p.source]
            types[p.name] = _FIXED_TYPES.get(p.transform, own)
    fields = [T.StructField(f.name, types[f.name], True) for f in found.fields]
    fields += [T.StructField(p.name, _FIXED_TYPES.get(p.transform, types.get(p.source)), True)
               for p in layout if p.name not in types]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _part_of(p: Part, value: Column, dtype: T.DataType) -> Column:
    if p.transform == "truncate" and isinstance(dtype, T.StringType):
        return F.substring(value, 1, p.param)
    return transform_value(p, value)


def derived_predicate(layout: list[Part], source: str, dtype: T.DataType, start=None, end=None,
                      equals=None, prefix: str | None = None) -> Column | None:
    """Partition predicate implied by a predicate on ``source`` (of type ``dtype``).

    Values take the column's type before they are transformed, so that 5 on a
    double column is hashed as 5.0.  Range ``start <= source < end`` maps to
    ``unit(start) <= part <= unit(end)`` for monotone time transforms
    (inclusive at the top: a superset, exact after the original filter).
    Equality maps through every transform; a string prefix maps through
    truncate, cut to the shorter of the two.
    """
    def lit(v) -> Column:
        return F.lit(v).cast(dtype)

    preds = []
    for p in layout:
        if p.source != source:
            continue
        part = F.col(p.name)
        if p.transform in ("years", "months", "days", "hours"):
            if start is not None:
                preds.append(part >= transform_value(p, lit(start)))
            if end is not None:
                preds.append(part <= transform_value(p, lit(end)))
        if equals is not None:
            preds.append(part == _part_of(p, lit(equals), dtype))
        if p.transform == "truncate" and prefix is not None and isinstance(dtype, T.StringType):
            preds.append(part == F.lit(prefix[:p.param]) if len(prefix) >= p.param else part.startswith(prefix))
    return reduce(lambda x, y: x & y, preds) if preds else None


def pruned_read(spark: SparkSession, path: str, layout: list[Part], source: str,
                start=None, end=None, equals=None, prefix: str | None = None,
                schema: T.StructType | None = None) -> DataFrame:
    """Filter by the plain column; the layout predicate is added for pruning."""
    df = read_layout(spark, path, layout, schema)
    c, dtype = F.col(source), df.schema[source].dataType
    conds = []
    if start is not None:
        conds.append(c >= F.lit(start).cast(dtype))
    if end is not None:
        conds.append(c < F.lit(end).cast(dtype))
    if equals is not None:
        conds.append(c == F.lit(equals).cast(dtype))
    if prefix is not None:
        conds.append(c.startswith(prefix))
    derived = derived_predicate(layout, source, dtype, start, end, equals, prefix)
    for cond in ([derived] if derived is not None else []) + conds:
        df = df.where(cond)
    return df


def union_layouts(parts: list[DataFrame]) -> DataFrame:
    """Data kept under several layouts, read as one table (by column name)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
