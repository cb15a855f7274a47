"""What a watermark drops, computed as a batch query over stored arrivals.

A streaming aggregate drops a row when its window has already closed: the
window end is at or before the watermark in force when the row's
micro-batch starts, i.e. max(event_time) over all *earlier* micro-batches
minus the allowed lateness.  Spark only counts such rows; this returns them.

The watermark per batch is a running maximum over batches, computed as a
blocked parallel prefix scan (``prefix_max_before``) so no task sees more
than one block of batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prefix_max_before(rows: DataFrame, order: str, value: str, block: int = 4096,
                      groups: tuple[str, ...] = (), levels: int = 3) -> DataFrame:
    """For each row, max(value) over rows of its group with a smaller ``order``
    (NULL for the first).  ``order`` must be a unique long within a group.

    A parallel prefix scan: rows are cut into blocks of ``block`` consecutive
    orders; each block is scanned on its own, and the per-block maxima are
    scanned the same way, recursively, ``levels`` deep.  No window partition
    holds more than ``block`` rows until the top level, which holds one row
    per block^levels rows of a group (a few rows even for a key with a
    third of 10^12 rows).
    """
    g = list(groups)
    blk, inner, before = f"_blk{levels}", f"_in{levels}", f"_before{levels}"
    o = F.col(order).cast("long")
    b = rows.withColumn(blk, ((o - F.pmod(o, F.lit(block))) / F.lit(block)).cast("long"))
    within = Window.partitionBy(*g, blk).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn(inner, F.max(value).over(within))
    blocks = b.groupBy(*g, blk).agg(F.max(value).alias("_bmax"))
    if levels > 1:
        blocks = (prefix_max_before(blocks, blk, "_bmax", block, groups, levels - 1)
                  .select(*g, blk, F.col("_bmax_before").alias(before)))
    else:
        over_blocks = Window.partitionBy(*g).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
        blocks = blocks.withColumn(before, F.max("_bmax").over(over_blocks)).drop("_bmax")
    # Null-safe on the group: a NULL key is a key like others.
    same = F.col(f"l.{blk}") == F.col(f"r.{blk}")
    for c in g:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return (b.alias("l").join(blocks.alias("r"), same, "left").select("l.*", f"r.{before}")
            .withColumn(f"{value}_before", F.greatest(inner, before))
            .drop(blk, inner, before))


def out_of_order(messages: DataFrame, group: tuple[str, ...] = ("partition", "key"),
                 order: str = "offset", ts: str = "ts") -> DataFrame:
    """Per (partition, key): messages, and how many arrived after a newer one.

    The source only orders messages within a partition, and the event time
    need not follow the offset even there; every consumer here re-orders by
    (ts, seq) instead of trusting arrival order.
    """
    pm = prefix_max_before(messages.select(*group, order, ts), order, ts, groups=group)
    return (pm.groupBy(*group)
            .agg(F.count(F.lit(1)).alias("message_count"),
                 F.count(F.when(F.col(ts) < F.col(f"{ts}_before"), 1)).alias("out_of_order")))


def watermarks(trades: DataFrame, batch_col: str, lateness: str = "5 seconds",
               time_col: str = "event_time") -> DataFrame:
    """batch -> watermark in force when that micro-batch starts."""
    per_batch = trades.groupBy(batch_col).agg(F.max(time_col).alias("_max"))
    pm = prefix_max_before(per_batch, batch_col, "_max")
    return pm.select(batch_col, (F.col("_max_before") - F.expr(f"INTERVAL {lateness}")).alias("watermark"))


def late_rows(trades: DataFrame, batch_col: str, size: str = "1 minute",
              lateness: str = "5 seconds", time_col: str = "event_time") -> DataFrame:
    """Rows a windowed streaming aggregate would drop, given their arrival batch."""
    wm = watermarks(trades, batch_col, lateness, time_col)
    w_end = F.window(time_col, size).end
    return (trades.join(wm, batch_col, "left")
            .where(F.col("watermark").isNotNull() & (w_end <= F.col("watermark")))
            .drop("watermark"))
