"""SimHash near-duplicates by tiled exact comparison of fingerprints.

A document's fingerprint is the majority vote, bit by bit, over the XXH64
hashes of its word shingles.  Distinct fingerprints are dealt into tiles of one
population count each; two fingerprints within ``radius`` bits have population
counts within ``radius``, so only such tile pairs meet.  A pair of tiles is
compared in full with numpy exclusive-or and bit counts; blocks inside it are
skipped by the same bound on the counts of the four 16-bit lanes.

Each pair of tiles gives back a spanning forest of its links, never the links
themselves, so a group of n near copies costs O(n) rows for each tile pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import by_place, components, extended, merged, own_columns, roots, saved

TILE = 8192
BLOCK = 256
VOTES = 1 << 16
SEED = 42


def fingerprint(text: str | None, shingle_words: int) -> int:
    """Signed 64-bit SimHash of a whole text; 0 where it has no words."""
    words = b"" if text is None else text.encode()
    words = words.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    k = min(shingle_words, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest, n, votes = xxhash.xxh64_intdigest, len(words) - k + 1, np.zeros(64, dtype=np.int64)
    for i in range(0, n, VOTES):
        spans = zip(starts[i: min(n, i + VOTES)].tolist(), ends[i + k - 1: min(n, i + VOTES) + k - 1].tolist())
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<i8")[0])


def with_fingerprints(texts: DataFrame, shingle_words: int, keep: list[str]) -> DataFrame:
    """``keep`` and fp (long) for each row; texts has the column text."""
    schema = extended(texts.select(*keep).schema, "fp long")

    def run(batches):
        for b in batches:
            fp = pa.array([fingerprint(t, shingle_words) for t in b.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), fp], names=[*keep, "fp"])

    return texts.select(*keep, "text").mapInArrow(run, schema)


def _lanes(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def tile_forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (node, root) of the links between tiles a and b, or within a."""
    def dealt(x):
        x = x[np.lexsort(_lanes(x).T[::-1])]
        cuts = np.arange(0, len(x), BLOCK)
        lanes = _lanes(x)
        return x, cuts, np.minimum.reduceat(lanes, cuts), np.maximum.reduceat(lanes, cuts)

    a, cuts_a, low_a, high_a = dealt(a)
    both, cuts_b, low_b, high_b = (a, cuts_a, low_a, high_a) if b is None else dealt(b)
    nodes = a if b is None else np.concatenate([a, both])
    shift = 0 if b is None else len(a)
    parent = np.arange(len(nodes))
    for k, i in enumerate(cuts_a):
        gap = np.maximum(0, np.maximum(low_b - high_a[k], low_a[k] - high_b)).sum(1)
        near = np.flatnonzero(gap <= radius)
        if b is None:
            near = near[near >= k]
        for part in np.array_split(near, max(1, len(near) * BLOCK // TILE)):
            if not len(part):
                continue
            at = (cuts_b[part][:, None] + np.arange(BLOCK)).ravel()
            at = at[at < len(both)]
            x, y = np.nonzero(np.bitwise_count(a[i: i + BLOCK, None] ^ both[at][None, :]) <= radius)
            merged(parent, x + i, at[y] + shift)
    top = roots(parent, np.arange(len(nodes)))
    child = np.flatnonzero(top != np.arange(len(nodes)))
    return nodes[child], nodes[top[child]]


def linked(fps: DataFrame, radius: int) -> DataFrame:
    """(a, b): spanning edges of the links between distinct fingerprints (column fp)."""
    counts = {r["p"]: r["n"] for r in fps.groupBy(F.bit_count("fp").alias("p")).agg(F.count("*").alias("n")).collect()}
    blocks = [-(-counts.get(p, 0) // TILE) for p in range(65)]  # at most 65 rows came back
    first = np.concatenate([[0], np.cumsum(blocks)]).tolist()
    lookup = F.array(*[F.struct(F.lit(blocks[p]).alias("blocks"), F.lit(first[p]).alias("first"),
                                F.lit(first[max(0, p - radius)]).alias("low"),
                                F.lit(first[min(64, p + radius) + 1] - 1).alias("high")) for p in range(65)])
    tiles = (fps.withColumn("c", F.element_at(lookup, F.bit_count("fp") + 1))
             .withColumn("t", F.expr("c.first + pmod(xxhash64(fp), c.blocks)").cast("int"))
             .groupBy("t", "c").agg(F.collect_list("fp").alias("fps")))
    dealt = (tiles.withColumn("u", F.explode(F.expr("sequence(c.low, c.high)")))
             .select(F.least("t", "u").alias("x"), F.greatest("t", "u").alias("y"), "t", "fps"))

    def run(table: pa.Table) -> pa.Table:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        tile = {t.as_py(): np.asarray(f.values).view(np.uint64) for t, f in zip(table.column("t"), table.column("fps"))}
        a, b = [], []
        if x in tile and y in tile:
            a, b = (v.view(np.int64) for v in tile_forest(tile[x], None if x == y else tile[y], radius))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("x", "y").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle_words: int = 4, radius: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits) and component_id.

    component_id is the smallest id reachable over fingerprints that differ in
    at most ``radius`` bits.  A null, empty or blank text has fingerprint zero,
    linked like any other; a null id takes its component's smallest id (null if
    the component has none); repeated rows stay repeated; an empty table gives
    no rows; further columns are ignored.
    """
    keyed = saved(with_fingerprints(own_columns(docs, id=id_col, text=text_col), shingle_words, ["id"]), "simhash")
    groups = keyed.groupBy("fp").agg(F.min("id").alias("least"))
    groups = saved(groups, "simhash-groups")
    root = components(linked(groups.select("fp"), radius), "simhash")
    placed = (groups.join(root.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return keyed.join(named, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle_words: int = 4, radius: int = 4, text_col: str = "text",
                id_col: str = "doc_id", stored: bool = False) -> DataFrame:
    """The rows of ``docs`` with one document of each group of near-duplicates.

    The row kept is the one with the smallest id (nulls last), ties broken by the
    text's hash; of rows equal in both exactly one.  Columns of any type a file can
    hold stay as they are.  Fingerprints are grouped beside the texts, which move
    once, to be matched with the rows that stay; rows are told apart by their place
    (see ``by_place``; ``stored`` says that ``docs`` is read straight from files).
    """
    rows = by_place(docs, stored, "simhash-rows")
    doc = F.col("doc")
    light = rows.select("file", "row", doc.getField(id_col).alias("id"), doc.getField(text_col).alias("text"))
    keyed = saved(with_fingerprints(light.withColumn("h", F.xxhash64("text")), shingle_words, ["file", "row", "id", "h"]), "simhash")
    groups = saved(keyed.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h", "file", "row")).alias("first")), "simhash-groups")
    root = components(linked(groups.select("fp"), radius), "simhash")
    keep = (groups.join(root.withColumnRenamed("node", "fp"), "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
            .agg(F.min("first").alias("first")).select(F.col("first.file").alias("file"), F.col("first.row").alias("row")))
    kept = rows.join(keep, ["file", "row"], "left_semi")
    return kept.select(*[doc.getField(c).alias(c) for c in docs.columns])
