"""Embedding near-duplicates: an exact metric range join over pivot cells.

Unit vectors with cosine >= c lie within r = sqrt(2 - 2c) of each other.  A few
pivots cut the distinct vectors into cells by nearest pivot.  If y lives in
cell j and lies within r of x, the triangle inequality gives
d(x, p_j) <= d(x, p_home) + 2r, and x lies within r of the plane halfway between
the two pivots; x is replicated into exactly the later cells where both hold.
Every cell is then joined on its own: its own vectors with each other and with
the replicas, block by block, so no task holds more than two blocks.

The blocks give back link counts and a spanning forest, never the pairs, and
equal vectors are folded into one with a weight beforehand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import components, extended, merged, own_columns, roots, saved

CELL = 4096
PIVOTS = 64
BLOCK = 8192
STRIP = 512
SLICE = 2048
SLACK = 1e-9


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column as doubles; shorter rows are extended with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten().cast(pa.float64()))
    width = int(sizes.max()) if len(sizes) else 0
    if len(flat) == len(sizes) * width:
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest component first, so that no square overflows."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def aligned(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def usable(column: str) -> F.Column:
    """The vector is neither null, empty nor zero, and every component is finite."""
    return F.col(column).isNotNull() & F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(column, lambda x: x != 0)


def _placed(vectors: DataFrame, pivots: np.ndarray, radius: float) -> DataFrame:
    """(node, vec, cell, own) for the home cell and each later cell that may hold a neighbour."""
    apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
    schema = extended(vectors.schema, "cell int, own boolean")

    def run(batches):
        for b in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            x, p = aligned(unit(matrix(b.column("vec"))), pivots)
            cosine = x @ p.T
            home = cosine.argmax(1)
            best = cosine[np.arange(len(x)), home]
            far = np.sqrt(np.maximum(2 - 2 * cosine, 0))
            ball = far <= far[np.arange(len(x)), home][:, None] + 2 * radius + SLACK
            plane = best[:, None] - cosine <= radius * apart[home] + SLACK
            row, cell = np.nonzero(ball & plane & (np.arange(len(p))[None, :] >= home[:, None]))
            taken = b.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(cell.astype(np.int32)), pa.array(cell == home[row])], schema=pa.schema(
                    [*taken.schema, ("cell", pa.int32()), ("own", pa.bool_())]))

    return vectors.mapInArrow(run, schema)


def block_links(a: np.ndarray, b: np.ndarray | None, wa: np.ndarray, wb: np.ndarray | None, least: float):
    """Weighted link counts of a's and b's rows, and the spanning forest over both."""
    same = b is None
    b, wb = (a, wa) if same else (b, wb)
    a, b = aligned(a, b)
    counts_a, counts_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    parent, shift = np.arange(len(a) + (0 if same else len(b))), 0 if same else len(a)
    for i in range(0, len(a), STRIP):
        start = i if same else 0
        hits = a[i: i + STRIP] @ b[start:].T >= least
        if not hits.any():
            continue
        x, y = np.nonzero(hits)
        x, y = x + i, y + start
        if same:
            x, y = x[y > x], y[y > x]
        np.add.at(counts_a, x, wb[y])
        np.add.at(counts_b if not same else counts_a, y, wa[x])
        merged(parent, x, y + shift)
    return counts_a, counts_b, roots(parent, np.arange(len(parent)))


def _links(placed: DataFrame, least: float) -> DataFrame:
    """(kind, a, b): kind 0 adds b links to node a, kind 1 is a spanning edge."""
    rows = placed.groupBy("cell").agg(F.count_if("own").alias("o"), F.count_if(~F.col("own")).alias("r")).collect()
    sizes = {r["cell"]: (-(-r["o"] // BLOCK), -(-r["r"] // BLOCK)) for r in rows}  # one row for each pivot
    lookup = F.array(*[F.struct(F.lit(sizes.get(c, (0, 0))[0]).alias("o"), F.lit(sizes.get(c, (0, 0))[1]).alias("r"))
                       for c in range(max(sizes, default=0) + 1)])
    # Own blocks are 0..o-1, replica blocks o..o+r-1; a task is (cell, x, y) with x an own block and x <= y.
    dealt = (placed.withColumn("n", F.element_at(lookup, F.col("cell") + 1))
             .withColumn("block", F.expr("if(own, pmod(xxhash64(node), greatest(n.o, 1)), n.o + pmod(xxhash64(node), greatest(n.r, 1)))").cast("int"))
             .withColumn("other", F.explode(F.expr("if(own, sequence(0, n.o + n.r - 1), if(n.o > 0, sequence(0, n.o - 1), array()))")))
             .select("cell", F.least("block", F.col("other").cast("int")).alias("x"),
                     F.greatest("block", F.col("other").cast("int")).alias("y"), "block", "node", "weight", "vec"))

    def run(table: pa.Table) -> pa.Table:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        block = table.column("block").to_numpy()
        nodes, weights, vecs = table.column("node").to_numpy(), table.column("weight").to_numpy(), unit(matrix(table.column("vec")))
        left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
        out = [np.empty((0, 3), np.int64)]
        if len(left) and len(right):
            same = x == y
            ca, cb, top = block_links(vecs[left], None if same else vecs[right], weights[left],
                                      None if same else weights[right], least)
            both = nodes[left] if same else nodes[np.concatenate([left, right])]
            counts = ca if same else np.concatenate([ca, cb])
            hit, child = np.flatnonzero(counts), np.flatnonzero(top != np.arange(len(top)))
            out += [np.stack([np.zeros(len(hit), np.int64), both[hit], counts[hit]], 1),
                    np.stack([np.ones(len(child), np.int64), both[child], both[top[child]]], 1)]
        kind, a, b = np.concatenate(out).T
        return pa.table({"kind": kind, "a": a, "b": b})

    return dealt.groupBy("cell", "x", "y").applyInArrow(run, "kind long, a long, b long")


def near_duplicates(embeddings: DataFrame, least: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Cosine is taken in double precision over all rows.  Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing and are
    their own component.  Equal vectors link with each other (repeated rows
    included); of vectors of different length the shorter is extended with
    zeros.  Rows with a null id link like others, count as links, and never name
    a component unless no row of it has an id.  An empty table gives no rows.
    """
    held = own_columns(embeddings, id=id_col, vec=vec_col).withColumn("ok", usable("vec"))
    held = saved(held.withColumn("row", F.monotonically_increasing_id()), "vectors")
    # Negative zero equals zero here: adding zero folds them before grouping.
    folded = saved(held.where("ok").groupBy(F.transform("vec", lambda x: x + F.lit(0).cast("float")).alias("vec"))
                   .agg(F.min("row").alias("node"), F.count("*").alias("weight"), F.min("id").alias("least")), "vectors-folded")
    n = folded.count()
    chosen = folded.orderBy(F.xxhash64("vec"), "node").limit(max(1, min(PIVOTS, -(-n // CELL)))).select("vec").toArrow()
    if n:
        radius = float(np.sqrt(2 - 2 * least))
        placed = saved(_placed(folded.select("node", "weight", "vec"), unit(matrix(chosen.column("vec"))), radius), "vectors-placed")
        found = saved(_links(placed, least), "vectors-links")
    else:
        found = held.where("false").select(F.lit(0).cast("long").alias("kind"), F.col("row").alias("a"), F.col("row").alias("b"))
    counts = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    root = components(found.where("kind = 1").select("a", "b"), "vectors")
    known = (folded.join(counts, "node", "left").join(root, "node", "left")
             .withColumn("root", F.coalesce("root", "node")).withColumn("links", F.coalesce("links", F.lit(0)) + F.col("weight") - 1))
    ids = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(ids, "root").select(F.col("vec").alias("v"), "links", "component_id")
    key = F.when(F.col("ok"), F.transform("vec", lambda x: x + F.lit(0).cast("float")))
    return (held.withColumn("key", key).join(known, F.col("key") == F.col("v"), "left")
            .select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))))
