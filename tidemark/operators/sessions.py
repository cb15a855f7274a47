"""Session windows that stay parallel when one key holds most rows.

A plain ``groupBy(key, session_window(t, gap))`` sends every row of a key to
one task.  Here the time line is cut into panes one gap wide.  Two rows of
one pane are less than a gap apart, so a pane belongs to one session and can
be reduced to (first time, last time, count, sums) by an ordinary aggregate,
combined before the shuffle: raw rows never cross the network.  Panes are
then stitched per (key, bucket of consecutive panes), and only the first and
last fragment of each bucket, the ones that can touch a neighbour, are
stitched per key in a last small pass; interior fragments are final.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import finish_sum, merge_parts, part_names, sum_parts
from ..functions.time import interval_micros, to_ntz

MIN_PANES = 64  # fewer panes a bucket would leave every fragment on an edge


def _floor_div(c: Column, n: int) -> Column:
    """Floor division of longs without passing through a double."""
    return F.call_function("div", c - F.pmod(c, F.lit(n).cast("long")), F.lit(n).cast("long"))


def sessions(df: DataFrame, keys: list[str], time_col: str, gap: str = "5 minutes",
             sum_cols: tuple[str, ...] = (), bucket: str = "1 day") -> DataFrame:
    """One row per session: keys, session_start, session_end, event_count, sums.

    A session closes after a gap *longer* than ``gap``; rows exactly ``gap``
    apart stay together.  ``session_end`` = last event time + gap.
    """
    gap_us = interval_micros(gap)
    panes_a_bucket = max(MIN_PANES, interval_micros(bucket) // gap_us)
    t = F.col(time_col).cast("timestamp")
    rows = df.select(*keys, F.unix_micros(t).alias("_us"), *sum_cols).where(F.col("_us").isNotNull())
    merged = [p for c in sum_cols for p in merge_parts(c)]
    names = [p for c in sum_cols for p in part_names(c)]

    rows = rows.withColumn("_pane", _floor_div(F.col("_us"), gap_us))
    panes = (rows.groupBy(*keys, "_pane")
             .agg(F.min("_us").alias("_lo"), F.max("_us").alias("_hi"), F.count(F.lit(1)).alias("event_count"),
                  *[p for c in sum_cols for p in sum_parts(c, c)])
             .withColumn("_b", _floor_div(F.col("_pane"), panes_a_bucket)))

    def apart(lo: str, hi: str, w) -> Column:
        return F.when(F.col(lo) - F.lag(hi).over(w) <= gap_us, 0).otherwise(1)

    in_bucket = Window.partitionBy(*keys, "_b").orderBy("_pane")
    frag = (panes.withColumn("_new", apart("_lo", "_hi", in_bucket))
            .withColumn("_grp", F.sum("_new").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_last", F.max("_grp").over(Window.partitionBy(*keys, "_b")))
            .groupBy(*keys, "_b", "_grp")
            .agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sum("event_count").alias("event_count"),
                 *merged, F.max("_last").alias("_last"))
            .withColumn("_edge", (F.col("_grp") == 1) | (F.col("_grp") == F.col("_last"))))
    interior = frag.where(~F.col("_edge")).select(*keys, "_lo", "_hi", "event_count", *names)

    by_key = Window.partitionBy(*keys).orderBy("_lo")
    stitched = (frag.where(F.col("_edge"))
                .withColumn("_new", apart("_lo", "_hi", by_key))
                .withColumn("_stitch", F.sum("_new").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
                .groupBy(*keys, "_stitch")
                .agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sum("event_count").alias("event_count"),
                     *merged)
                .drop("_stitch"))

    out = interior.unionByName(stitched)
    return out.select(*keys, to_ntz(F.timestamp_micros("_lo")).alias("session_start"),
                      to_ntz(F.timestamp_micros(F.col("_hi") + gap_us)).alias("session_end"), "event_count",
                      *[finish_sum(c).alias(c) for c in sum_cols])
