"""Hard-negative mining with Four-Russians scoring.

Components count as whole numbers.  Candidates are stored as bit planes: plane b
holds bit b of every component (two's complement), eight components to a byte.
An anchor's components are cut into groups of eight, and for each group the sums
of all 256 subsets are worked out once.  A candidate's byte then names the sum
that its bits select, so a score is one table lookup a group and plane, the
planes joined by shifting and adding.  Scores are exact whole numbers.

Every block of anchors meets every block of candidates in a task of its own,
twice: first for the best rows of the anchor's label, then for the rows of other
labels inside the range that each of those positives allows.  A task hands on at
most k rows an anchor (and positive), so nothing grows with the table but the
number of tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import own_columns, saved
from tidemark.llm.embedding_dedup import matrix
from tidemark.llm.exact_topk import LONG, best

BLOCK = 8192         # candidates
ANCHORS = 256        # anchors that share tables
STRIP = 1024         # candidates scored at a time
GROUP = 8            # components to a byte
LEAST = np.iinfo(np.int64).min


def whole(column, scale: float) -> np.ndarray:
    """floor(scale * x) of every component: 64-bit whole numbers, Python's where those are too short."""
    rows = np.floor(matrix(column) * scale)
    if not rows.size or np.abs(rows).max() < 2.0**62:
        return rows.astype(np.int64)
    big = np.empty(rows.shape, object)
    big[...] = [[int(x) for x in r] for r in rows.tolist()]
    return big


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(planes, rows, groups) bytes, the lowest plane first; the highest one is the sign."""
    top = max((abs(int(v)) for v in (values.min(), values.max())), default=0) if values.size else 0
    width = -(-values.shape[1] // GROUP) * GROUP
    values = np.pad(values, ((0, 0), (0, width - values.shape[1])))
    planes = np.empty((top.bit_length() + 1, len(values), width // GROUP), np.uint8)
    for b in range(len(planes)):
        planes[b] = np.packbits(((values >> b) & 1).astype(bool), axis=1, bitorder="little").reshape(planes[b].shape)
    return planes


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): the sums of every subset of eight components."""
    width = -(-anchors.shape[1] // GROUP) * GROUP
    a = np.pad(anchors, ((0, 0), (0, width - anchors.shape[1]))).T.reshape(-1, GROUP, len(anchors))
    sums = np.zeros((len(a), 1 << GROUP, len(anchors)), anchors.dtype)
    for j in range(GROUP):
        sums[:, 1 << j: 2 << j] = sums[:, : 1 << j] + a[:, j: j + 1]
    return sums


def scores(planes: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """(rows, anchors) exact inner products; beyond a long they stop at its limits."""
    out = np.zeros((planes.shape[1], len(anchors)), np.int64)
    if not out.size:
        return out
    most = max(abs(int(anchors.min())), abs(int(anchors.max()))) if anchors.size else 0
    bound = (most * max(1, anchors.shape[1])) << len(planes)
    kind = np.int32 if bound < 1 << 30 else np.int64 if bound < 1 << 62 else object
    sums = subset_sums(anchors.astype(kind))
    groups = min(len(sums), planes.shape[2])
    for i in range(0, len(out), STRIP):
        z = slice(i, i + STRIP)
        total = np.zeros((len(out[z]), len(anchors)), kind)
        for b in range(len(planes) - 1, -1, -1):
            total += total
            for g in range(groups):
                if b == len(planes) - 1:
                    total -= sums[g][planes[b, z, g]]
                else:
                    total += sums[g][planes[b, z, g]]
        out[z] = np.clip(total, -LONG, LONG).astype(np.int64) if kind is object else total
    return out


def _index(held: DataFrame, blocks: int, scale: float) -> DataFrame:
    """One row a block: rows, ids, labels and bit planes of its candidates."""
    def pack(t: pa.Table) -> pa.Table:
        planes = bit_planes(whole(t.column("vec"), scale))
        return pa.table({"block": t.column("block").slice(0, 1), **{c + "s": pa.array([t.column(c).to_pylist()], pa.list_(t.schema.field(c).type))
                                                                   for c in ("row", "id", "label")},
                         "shape": pa.array([planes.shape], pa.list_(pa.int32())), "planes": pa.array([planes.tobytes()], pa.binary())})

    kinds = {c: held.schema[c].dataType.simpleString() for c in ("id", "label")}
    dealt = held.withColumn("block", F.expr(f"pmod(xxhash64(row), {blocks})").cast("int"))
    return saved(dealt.groupBy("block").applyInArrow(
        pack, f"block int, rows array<long>, ids array<{kinds['id']}>, labels array<{kinds['label']}>, shape array<int>, planes binary"), "negatives-index")


def _tile(left: pa.Table, right: pa.Table, scale: float):
    """Rows, ids, labels and (anchor, candidate) scores of a block of candidates against a block of anchors."""
    rows, ids, labels = (left.column(c)[0].values for c in ("rows", "ids", "labels"))
    shape = left.column("shape")[0].as_py()
    planes = np.frombuffer(left.column("planes")[0].as_py(), np.uint8).reshape(shape)
    known = pc.unique(labels)
    asked = pc.fill_null(pc.index_in(right.column("a_label").combine_chunks(), known), -1)
    same = np.asarray(asked)[:, None] == np.asarray(pc.index_in(labels, known))[None, :]
    return np.asarray(rows), ids, same, scores(planes, whole(right.column("vec"), scale)).T


def _met(index: DataFrame, anchors: DataFrame, blocks: int, asked_blocks: int, run, schema: str) -> DataFrame:
    """``run`` over every (block of candidates, block of anchors), one task group each."""
    left = index.withColumn("a_block", F.explode(F.sequence(F.lit(0), F.lit(asked_blocks - 1))))
    right = anchors.withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    nothing = index.sparkSession.createDataFrame([], schema).toArrow()
    return left.groupBy("block", "a_block").cogroup(right.groupBy("c_block", "a_block")).applyInArrow(
        lambda a, b: run(a, b) if a.num_rows and b.num_rows else nothing, schema)


def mine(embeddings: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0, every: int = 100,
         id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``.  Components x count
    as floor(scale * x), scores are inner products, higher first, ties to the
    smaller id.  An anchor's positives are its first ``positives`` other rows of
    the same label; for each, the first ``negatives`` rows of another label with
    low * positive <= 100 * negative <= high * positive are returned (none for a
    negative positive score: its range is empty).

    Rows take no part whose id or label is null, or whose vector is null or holds
    null or non-finite components.  Zero and empty vectors do (shorter vectors
    are extended with zeros).  Repeated rows are rows of their own: each is
    candidate, positive and anchor.  Scores beyond a long stop at its limits.  An
    empty table gives no rows; further columns are ignored.
    """
    fine = F.col("vec").isNotNull() & F.col("id").isNotNull() & F.col("label").isNotNull() & F.forall(
        "vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    held = own_columns(embeddings, id=id_col, vec=vec_col, label=label_col).where(fine)
    held = saved(held.withColumn("row", F.monotonically_increasing_id()), "negatives-vectors")
    asked = held.where(F.expr(f"id % {int(every)} = 0"))
    id_kind = held.schema["id"].dataType.simpleString()
    n, wanted = held.count(), asked.count()
    if not wanted:
        return embeddings.sparkSession.createDataFrame(
            [], f"anchor_id {id_kind}, positive_id {id_kind}, rank int, negative_id {id_kind}, positive_score long, negative_score long")
    blocks, asked_blocks = -(-n // BLOCK), -(-wanted // ANCHORS)
    index = _index(held, blocks, scale)
    anchors = saved(asked.select(F.col("row").alias("a_row"), F.col("id").alias("a_id"), F.col("label").alias("a_label"), "vec",
                                 F.expr(f"pmod(xxhash64(row), {asked_blocks})").cast("int").alias("a_block")), "negatives-anchors")

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, ids, same, found = _tile(left, right, scale)
        own = right.column("a_row").to_numpy()
        q, m = best(np.where(same, found, LEAST), np.asarray(ids), rows, own, positives)
        at = pa.array(m)
        return pa.table({"a_row": own[q], "p_row": rows[m], "p_id": ids.take(at), "p_score": found[q, m]})

    order = Window.partitionBy("a_row").orderBy(F.desc("p_score"), "p_id", "p_row")
    near = _met(index, anchors, blocks, asked_blocks, nearest, f"a_row long, p_row long, p_id {id_kind}, p_score long")
    chosen = saved(near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= positives), "negatives-positives")
    # At most ``positives`` rows an anchor come together here.
    listed = chosen.groupBy("a_row").agg(F.sort_array(F.collect_list(F.struct("k", "p_row", "p_id", "p_score"))).alias("ps"))

    def hard(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, ids, same, found = _tile(left, right, scale)
        own = right.column("a_row").to_numpy()
        known = right.column("ps").to_pylist()
        out = []
        for k in range(positives):
            held_by = np.array([i for i, p in enumerate(known) if len(p) > k], np.int64)
            if not len(held_by):
                break
            positive = [known[i][k] for i in held_by.tolist()]
            bounds = np.array([[-(-low * p["p_score"] // 100), high * p["p_score"] // 100] for p in positive], object)
            least, most = (np.array([min(max(int(v), -LONG), LONG) for v in bounds[:, c]], np.int64)[:, None] for c in (0, 1))
            part = found[held_by]
            inside = ~same[held_by] & (part >= least) & (part <= most)
            q, m = best(np.where(inside, part, LEAST), np.asarray(ids), rows, own[held_by], negatives)
            out.append((held_by[q], [positive[i] for i in q.tolist()], m))
        q, m = (np.concatenate([np.empty(0, np.int64), *[o[c] for o in out]]) for c in (0, 2))
        p = [x for o in out for x in o[1]]
        return pa.table({"a_id": right.column("a_id").take(pa.array(q)), "a_row": own[q], "p_row": pa.array([x["p_row"] for x in p], pa.int64()),
                         "p_id": pa.array([x["p_id"] for x in p], right.column("a_id").type), "p_score": pa.array([x["p_score"] for x in p], pa.int64()),
                         "row": rows[m], "id": ids.take(pa.array(m)), "score": found[q, m]})

    found = _met(index, anchors.join(listed, "a_row"), blocks, asked_blocks, hard,
                 f"a_id {id_kind}, a_row long, p_row long, p_id {id_kind}, p_score long, row long, id {id_kind}, score long")
    order = Window.partitionBy("a_row", "p_row").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= negatives).select(
        F.col("a_id").alias("anchor_id"), F.col("p_id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("p_score").alias("positive_score"), F.col("score").alias("negative_score"))
