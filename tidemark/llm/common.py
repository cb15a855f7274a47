"""Helpers shared by the corpus operators: saved tables, word spans and hashes, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tidemark.session import scratch_path

WHITE_SPACE = b" \t\n\x0b\x0c\r"
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
HASH_CHUNK = 1 << 17
HASH_BITS = 16
MANY_GROUPS = 10_000  # rows of two values; more than these are not broadcast

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(WHITE_SPACE)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xFF51AFD7ED558CCD)
_MIX_B = np.uint64(0xC4CEB9FE1A85EC53)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs the tasks it ran and nothing else.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def extended(schema: StructType, ddl: str) -> StructType:
    """A new schema with the fields of ``ddl`` after those of ``schema``."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def by_place(docs: DataFrame, stored: bool, name: str) -> DataFrame:
    """(doc, file, row): every row as a struct, and two longs that tell it from all others, equal ones too.

    With ``stored``, ``docs`` is read straight from files: file is a 64-bit hash of
    the file's path, row the position in it.  Else the rows are saved, numbered.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    if stored:
        return docs.select(whole, F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return saved(docs.select(whole, F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("row")), name)


def own_columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns, under private names (``new=old``).

    Everything an operator computes lives beside these, so further columns of
    the input can't clash with its own.
    """
    return df.select(*[df[old].alias(new) for new, old in wanted.items()])


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * _MIX_A
        h = h ^ (h >> np.uint64(33))
        h = h * _MIX_B
        return h ^ (h >> np.uint64(33))


def as_bytes(texts: list, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8, one space after each, and where each text begins (nulls are empty)."""
    parts = [b"" if t is None else (t if isinstance(t, bytes) else t.encode()) for t in texts]
    data = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
    sizes = np.fromiter((len(p) + 1 for p in parts), dtype=np.int64, count=len(parts))
    begins = np.concatenate([[0], np.cumsum(sizes)])[: len(parts)]
    return (LOWER[data] if lower else data), begins


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes that are not ASCII white space (data ends in a space)."""
    inside = np.concatenate([[False], ~_IS_SPACE[data]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[0::2], turns[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, computed over whole arrays of bytes at a time."""
    out = np.empty(len(starts), dtype=np.uint64)
    sizes = ends - starts
    if not len(starts):
        return out
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max()), _STEP, dtype=np.uint64), dtype=np.uint64)
        total = np.cumsum(sizes)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + HASH_CHUNK, "right")))
            n, first = sizes[i:j], total[i:j] - sizes[i:j]
            first = first - first[0]
            place = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(first, n)
            byte = data[np.repeat(starts[i:j], n) + place]
            out[i:j] = np.add.reduceat(_BYTE_VALUES[byte] * powers[place], first)
            i = j
    return mixed(out)


def merged(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Union of the pairs (left[k], right[k]) in the forest ``parent``; the smaller index becomes the root."""
    while len(left):
        a, b = roots(parent, left), roots(parent, right)
        apart = a != b
        if not apart.any():
            return
        left, right = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(left, right), np.minimum(left, right))


def roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    up = parent[nodes]
    while True:
        higher = parent[up]
        if (higher == up).all():
            parent[nodes] = up
            return up
        up = higher


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node of its component.

    ``edges`` has long columns a and b.  Large-star and small-star rounds, each
    saved in the shared folder; only the rounds' checksums reach the driver.
    Aggregates combine before the shuffle, and a hub's rows are split by the
    adaptive skew join.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = saved(e, f"{name}-edges"), None
    while True:
        now = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.col("v").cast("decimal(20,0)"))).first()
        if not now[0] or now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        e = saved(small, f"{name}-round")


def crc_remainder(column: str, divisor: int):
    """crc32 of the value as text, modulo ``divisor`` (a null counts as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def bounded_sample(rows: DataFrame, group: str, text: str, most: int) -> DataFrame:
    """At most ``most`` distinct texts of each group: those with the smallest hashes, one row for each.

    The cut-off comes from hashes alone, so texts move only if they are chosen,
    and copies of one text count once.  Hashes are first counted by their leading
    ``HASH_BITS`` bits, summed before the shuffle; only those up to the range in
    which the group reaches ``most`` are ranked.  So no task holds a group: it
    holds 2^HASH_BITS counts, or ``most`` hashes and one range of them.
    """
    hashed = rows.withColumn("h", F.xxhash64(text))
    seen = saved(hashed.select(F.col(group).alias("g"), "h").distinct().withColumn("range", F.shiftright("h", 64 - HASH_BITS)), "sample-hashes")
    before = Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    needed = (seen.groupBy("g", "range").agg(F.count("*").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < most)
              .select(F.col("g").alias("n_g"), F.col("range").alias("n_range")))
    near = seen.join(needed, F.col("g").eqNullSafe(F.col("n_g")) & (F.col("range") == F.col("n_range")))
    order = Window.partitionBy("g").orderBy("h")
    cuts = saved(near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= most)
                 .groupBy("g").agg(F.max("h").alias("cut")), "sample-cuts")
    return (hashed.join(F.broadcast(cuts) if cuts.count() <= MANY_GROUPS else cuts, F.col(group) == F.col("g"))
            .where(F.col("h") <= F.col("cut")).dropDuplicates([group, "h"]).drop("h", "g", "cut"))


def text_column(batch: pa.RecordBatch, payload_text: str | None) -> pa.Array:
    """The texts of a batch: its column text, or the field ``payload_text`` of the whole row in ``doc``."""
    return batch.column("text") if payload_text is None else pc.struct_field(batch.column("doc"), payload_text).cast(pa.string())


def pieces(batch: pa.RecordBatch, limit: int, rows: int, payload_text: str | None = None):
    """(slice, texts) of a batch: few rows and about ``limit`` characters at a time, whole texts.

    Only the texts of one slice are Python strings at any time.
    """
    for i in range(0, batch.num_rows, rows):
        part = batch.slice(i, rows)
        texts = text_column(part, payload_text).to_pylist()
        for a, b in chunks(texts, limit):
            yield part.slice(a, b - a), texts[a:b]


def chunks(texts: list, limit: int):
    """(from, to) ranges of texts of about ``limit`` characters; a longer text stands alone."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > limit:
            yield at, i
            at, size = i, 0
        size += len(t or "")
    if at < len(texts):
        yield at, len(texts)
