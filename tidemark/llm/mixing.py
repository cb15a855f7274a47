"""Mixing sources to target weights by systematic sampling; DataFrame functions only.

Every document of a source has the same expected number of copies,
rate = target / source size.  Documents of a source stand in order of size (then
md5 of the id); the prefix sum of their rates, shifted by one random offset per
source, crosses whole numbers, and a document is emitted once for each crossing
within its own stretch.  Ordering by size keeps the words taken near the target
as well as the number of documents.

The place in the order comes from counts, not from one long sort: documents are
counted by (source, size, slot), slots being ranges of the md5, the counts are
summed up within the source, and only documents of one slot are numbered by a
window.  Slots are cut as a (source, size) group needs, so a source, or one text
copied a billion times, is spread over as many windows as it takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import WORD_PATTERN, by_place, saved

SLOT = 1 << 11
HEX = 7
CEILING = 3
WEIGHTS = 3
DRAWS = 16
MANY_SOURCES = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, ceiling: int = CEILING, weights: int = WEIGHTS) -> DataFrame:
    """source, source_size, target for sizes (source, source_size): one row per source, so one small window.

    Weighted shares stop at ``ceiling`` times the source's size and the excess
    is shared anew by weight.  Sources that stop come first when sorted by
    ceiling / weight, so one pass finds where stopping ends.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = sizes.withColumn("weight", (F.row_number().over(by_name) - 1) % weights + 1)
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    zero = F.lit(0).cast("long")
    w = (w.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("source_size").over(before), zero) * ceiling)
         .withColumn("share", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), zero)))
    # From the first source whose share fits under its ceiling on, all do.
    w = w.withColumn("fits", F.col("left") * F.col("weight") <= F.col("source_size") * ceiling * F.col("share"))
    free = F.min(F.when(F.col("fits"), F.struct(F.col("source_size") / F.col("weight"), F.col("left"), F.col("share")))).over(every)
    w = w.withColumn("first", free)
    return w.select("source", "source_size", F.when(
        F.col("fits"), (F.col("first.left") * F.col("weight")).cast("double") / F.col("first.share").cast("double"))
        .otherwise((F.col("source_size") * ceiling).cast("double")).alias("target"))


def offset(source: Column, seed: str, draw: int) -> Column:
    """The draw-th number in [0, 1) that belongs to the source: the same in every run."""
    name = F.concat(F.lit(f"{seed}{draw}"), F.when(source.isNull(), "n").otherwise("s"), F.coalesce(source, F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def _copies(shift: Column) -> Column:
    """Whole numbers crossed between the prefix sums before and after the document."""
    return (F.floor(shift + F.col("rate") * F.col("at")) - F.floor(shift + F.col("rate") * (F.col("at") - 1))).cast("long")


def mix(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        key_cols: list[str] | None = None) -> DataFrame:
    """doc_id, size, source_size, target, copies, key for every document.

    key is a struct of ``key_cols``, which tell rows apart (the text's hash by default).

    size is the number of words (null text: 0); a document is taken ``copies``
    (0 to 3) times.  Null sources are one source, ranked last.  Documents
    without words take part and weigh nothing.  Each source has one offset, the
    one of ``DRAWS`` seeded draws whose words come nearest its target.  Rows with
    equal ids are ordered by md5, then by the text's hash; equal rows are told
    apart by the window only, so the multiset of results is the same in every
    run.  An empty table gives no rows; further columns are ignored.
    """
    key = F.struct(*[docs[c] for c in key_cols]) if key_cols else F.struct(F.xxhash64(docs[text_col]).alias("text"))
    held = docs.select(docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"),
                       word_count(docs[text_col]).alias("size"), key.alias("tie"),
                       F.md5(F.coalesce(docs[id_col].cast("string"), F.lit(""))).alias("spot"))
    held = saved(held, "mix")
    groups = held.groupBy("source", "size").agg(F.count("*").alias("n"))
    sizes = groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    # Only groups of more than SLOT documents are cut: at most rows / SLOT of them, and so many slots more.
    wide = groups.where(F.col("n") > SLOT).select(
        F.col("source").alias("w_source"), F.col("size").alias("w_size"), (1 + F.floor(F.col("n") / SLOT)).alias("slots"))
    share = F.conv(F.substring("spot", 1, HEX), 16, 10).cast("long") * F.coalesce("slots", F.lit(1)) / F.lit(16**HEX)
    held = held.join(wide, held["source"].eqNullSafe(wide["w_source"]) & (held["size"] == wide["w_size"]), "left").withColumn(
        "slot", share.cast("long")).drop("w_source", "w_size", "slots")
    order = Window.partitionBy("source").orderBy("size", "slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = (held.groupBy("source", "size", "slot").agg(F.count("*").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
              .select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("slot").alias("l"), "before"))
    aimed = targets(sizes).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    starts = saved(counts.join(aimed, counts["s"].eqNullSafe(aimed["source"])).drop("source"), "mix-starts")
    place = F.row_number().over(Window.partitionBy("source", "size", "slot").orderBy("spot", "tie"))

    def placed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("place", place).join(
            starts, rows["source"].eqNullSafe(starts["s"]) & (rows["size"] == starts["z"]) & (rows["slot"] == starts["l"])
        ).withColumn("at", F.col("before") + F.col("place"))

    # The words that each draw would take, summed within source before the shuffle.
    tried = placed(held).groupBy("source").agg(
        F.first("target").alias("t"), *[F.sum(F.col("size") * _copies(offset(F.col("source"), seed, k))).alias(f"w{k}") for k in range(DRAWS)])
    chosen = tried.select(F.col("source").alias("of"), F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"w{k}") - F.col("t")).alias("miss"), F.lit(k).alias("draw"), offset(F.col("source"), seed, k).alias("shift"))
        for k in range(DRAWS)]))["shift"].alias("shift"))
    drawn = placed(held).join(F.broadcast(chosen) if sizes.count() <= MANY_SOURCES else chosen,
                              F.col("source").eqNullSafe(F.col("of")))
    return drawn.select(F.col("id").alias(id_col), "size", "source_size", "target", _copies(F.col("shift")).alias("copies"),
                        F.col("tie").alias("key"))


def mixed_documents(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                    stored: bool = False) -> DataFrame:
    """The rows of the mix with the columns of ``docs``, a document taken n times standing n times.

    Copies are worked out beside the texts, which move once, to meet the copies of
    their own row.  Rows are told apart by their place: with ``stored``, ``docs`` is
    read straight from files and that is file (a 64-bit hash of its path) and
    position; else the rows are saved with a number each.  So rows equal in some or
    all columns, null ids, texts and sources, and columns of any type a file can hold
    (maps too) and any name each keep their own copies.  Ties are as in ``mix``; an
    empty table stays empty.
    """
    rows = by_place(docs, stored, "mix-rows")
    doc = F.col("doc")
    light = rows.select("file", "row", doc.getField(id_col).alias("id"), doc.getField(source_col).alias("source"), doc.getField(text_col).alias("text"))
    taken = mix(light, seed, "id", "source", "text", key_cols=["file", "row"]).where("copies > 0").select(
        F.col("key.file").alias("t_file"), F.col("key.row").alias("t_row"), "copies")
    met = rows.join(taken, (F.col("file") == F.col("t_file")) & (F.col("row") == F.col("t_row")))
    return met.select(F.explode(F.expr("array_repeat(doc, cast(copies as int))")).alias("doc")).select(
        *[F.col("doc").getField(c).alias(c) for c in docs.columns])
