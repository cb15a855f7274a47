"""Order-independent sums of doubles.

A plain double sum depends on the order rows reach the aggregate, so replay,
re-partitioning or an executor retry can change its last digits.  Here every
value below ``LIMIT`` that DECIMAL(38, 15) holds without loss (prices and
quantities of up to 15 decimals) is summed as a decimal, exactly; at that
limit 10^13 rows fit before a decimal overflows.  All other values (larger,
finer, NaN, infinite) go to a double sum beside it, so none is rounded away
and none fails the query.  Both parts are hash-aggregated with a partial
aggregate before the shuffle.

``sum_parts`` / ``merge_parts`` / ``finish_sum`` carry the two parts through
several levels of aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(38,15)"
LIMIT = 1e10


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _split(col) -> tuple[Column, Column]:
    x = _c(col).cast("double")
    # The cast sees small numbers only: NaN and large values would not fit.
    d = F.when(F.abs(x) < LIMIT, x).try_cast(WIDE)
    held = F.coalesce(d.cast("double") == x, F.lit(False))
    return F.when(held, d), F.when(~held, x)


def sum_parts(col, name: str) -> list[Column]:
    """The decimal and the double part of a sum, as two named aggregates."""
    dec, rest = _split(col)
    return [F.sum(dec).alias(f"{name}_dec"), F.sum(rest).alias(f"{name}_dbl")]


def merge_parts(name: str) -> list[Column]:
    """Aggregates that merge parts made by ``sum_parts``."""
    return [F.sum(f"{name}_dec").cast(WIDE).alias(f"{name}_dec"), F.sum(f"{name}_dbl").alias(f"{name}_dbl")]


def part_names(name: str) -> list[str]:
    return [f"{name}_dec", f"{name}_dbl"]


def _total(dec: Column, rest: Column) -> Column:
    dec = dec.cast("double")
    return F.coalesce(dec + rest, dec, rest)


def finish_sum(name: str) -> Column:
    return _total(F.col(f"{name}_dec"), F.col(f"{name}_dbl"))


def exact_sum(col) -> Column:
    dec, rest = _split(col)
    return _total(F.sum(dec), F.sum(rest))


def exact_avg(col) -> Column:
    return exact_sum(col) / F.count(_c(col))
