"""Exact top-k by inner product over a pivot-distance index.

Vectors are scaled to whole numbers.  With one more component that brings every
stored vector to the same length, the largest inner product is the smallest
distance.  Each vector is keyed by its nearest pivot p and its distance to p,
sorted by that key, and cut into annuli of at most ``ANNULUS`` vectors, with the
least and largest distance of each.  A query first scores the annulus it falls
into, which gives it a k-th score; then it expands to the annuli that the
triangle inequality can't rule out: members of an annulus [lo, hi] are at least
max(lo - d(q, p), d(q, p) - hi) away.  Bounds only ever skip whole annuli that
hold no better score, so the result is exact for any data.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import extended, own_columns, saved
from tidemark.llm.embedding_dedup import aligned, matrix

ANNULUS = 4096
PIVOTS = 64
QUERY_BLOCK = 512
EXACT = 2.0**53
LONG = 2**63 - 1


def whole_numbers(column, scale: float) -> np.ndarray:
    return np.floor(matrix(column) * scale)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact; beyond a long they stop at its limits."""
    a, b = aligned(a, b)
    if a.size and b.size and a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max()) >= EXACT:
        big = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b.tolist()] for p in a.tolist()]
        return np.array([[max(-LONG, min(LONG, v)) for v in row] for row in big], dtype=np.int64).reshape(len(a), len(b))
    return (a @ b.T).astype(np.int64)


def _lifted(rows: np.ndarray, top: float) -> np.ndarray:
    return np.concatenate([rows, np.sqrt(np.maximum(top - (rows * rows).sum(1), 0))[:, None]], 1)


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (rows * rows).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def build(vectors: DataFrame, scale: float, pivots: np.ndarray, top: float) -> DataFrame:
    """The saved index: one row per annulus (annulus, pivot, lo, hi, n, rows, ids, vecs)."""
    lifted = _lifted(pivots, top)

    def keyed(batches):
        for b in batches:
            rows, p = aligned(whole_numbers(b.column("vec"), scale), pivots)
            d = _distances(_lifted(rows, top), np.concatenate([p, lifted[:, -1:]], 1))
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])],
                names=[*b.schema.names, "pivot", "dist"])

    def packed(batches):
        part, count, held = TaskContext.get().partitionId() if TaskContext.get() else 0, 0, None
        for table in batches:
            t = pa.Table.from_batches([table])
            held = t if held is None else pa.concat_tables([held, t])
            while held.num_rows > ANNULUS:
                piece, held, count = *_cut(held), count + 1
                yield _annulus(piece, (part << 32) + count)
        while held is not None and held.num_rows:
            piece, held, count = *_cut(held), count + 1
            yield _annulus(piece, (part << 32) + count)

    def _cut(held):
        pivot = held.column("pivot").to_numpy()
        n = min(ANNULUS, int(np.searchsorted(pivot, pivot[0], "right")))
        return held.slice(0, n), held.slice(n)

    def _annulus(piece, key):
        dist = piece.column("dist").to_numpy()
        return pa.RecordBatch.from_pydict({
            "annulus": pa.array([key], pa.int64()), "pivot": pa.array([piece.column("pivot")[0].as_py()], pa.int32()),
            "lo": [float(dist.min())], "hi": [float(dist.max())], "n": pa.array([piece.num_rows], pa.int32()),
            "rows": [piece.column("row").to_pylist()], "ids": [piece.column("id").to_pylist()],
            "vecs": pa.array([piece.column("vec").to_pylist()], pa.list_(piece.schema.field("vec").type))})

    kind = vectors.schema["vec"].dataType.simpleString()
    id_kind = vectors.schema["id"].dataType.simpleString()
    dealt = (vectors.mapInArrow(keyed, extended(vectors.schema, "pivot int, dist double"))
             .repartitionByRange("pivot", "dist", "row").sortWithinPartitions("pivot", "dist", "row"))
    return saved(dealt.mapInArrow(packed, "annulus long, pivot int, lo double, hi double, n int, rows array<long>, "
                                          f"ids array<{id_kind}>, vecs array<{kind}>"), "topk-index")


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query index, member index) of each query's k best, ties to the smaller id, then row; never its own row."""
    least = np.iinfo(np.int64).min
    if not scores.size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    scores = np.where(rows[None, :] == own[:, None], least, scores)
    k = min(k, scores.shape[1])
    cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    q, m = np.nonzero((scores >= cut[:, None]) & (scores > least))
    order = np.lexsort((rows[m], ids[m], -scores[q, m], q))
    q, m = q[order], m[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], m[rank < k]


def _scored(pairs: DataFrame, index: DataFrame, k: int, scale: float) -> DataFrame:
    """The k best members of each (annulus, query) pair, evaluated one annulus and block of queries at a time."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        q = m = np.empty(0, np.int64)
        own = right.column("q_row").to_numpy()
        members = ids = score = np.empty(0, np.int64)
        if left.num_rows and right.num_rows:
            members, ids = (np.asarray(left.column(c)[0].values) for c in ("rows", "ids"))
            score = products(whole_numbers(right.column("q_vec"), scale), whole_numbers(left.column("vecs")[0].values, scale))
            q, m = best(score, ids, members, own, k)
            members, ids, score = members[m], ids[m], score[q, m]
        return pa.table({"q_row": own[q], "q_id": right.column("q_id").take(pa.array(q)), "row": members, "id": ids, "score": score})

    blocks = pairs.select("annulus", "block").distinct()
    left = blocks.join(index.select("annulus", "rows", "ids", "vecs"), "annulus").select(
        F.col("annulus").alias("l_annulus"), F.col("block").alias("l_block"), "rows", "ids", "vecs")
    id_kind = pairs.schema["q_id"].dataType.simpleString()
    return left.groupBy("l_annulus", "l_block").cogroup(pairs.groupBy("annulus", "block")).applyInArrow(
        run, f"q_row long, q_id {id_kind}, row long, id {id_kind}, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(embeddings: DataFrame, k: int = 5, scale: float = 256.0, every: int = 50, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every query row (id divisible by ``every``) among all other rows.

    Components x count as floor(scale * x).  Rows whose vector is null or holds
    null or non-finite components, or whose id is null, take no part; zero and
    empty vectors do (shorter vectors are extended with zeros).  Repeated rows
    are candidates of each other, and each repeated query row has its own
    ranks.  Ties go to the smaller id.  An empty table gives no rows.
    """
    fine = F.col("vec").isNotNull() & F.col("id").isNotNull() & F.forall(
        "vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    held = own_columns(embeddings, id=id_col, vec=vec_col).where(fine)
    held = saved(held.withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    size = F.aggregate("vec", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * scale).cast("double"), 2))
    n, top = held.agg(F.count("*"), F.max(size)).first()
    schema = "query_id {0}, rank int, vec_id {0}, score long".format(held.schema["id"].dataType.simpleString())
    if not n:
        return embeddings.sparkSession.createDataFrame([], schema)
    top = float(top)
    chosen = held.orderBy(F.xxhash64("vec"), "row").limit(max(1, min(PIVOTS, -(-n // ANNULUS)))).select("vec").toArrow()
    pivots = whole_numbers(chosen.column("vec"), scale)
    index = build(held, scale, pivots, top)
    lifted = _lifted(pivots, top)

    def reach(batches):
        for b in batches:
            rows, p = aligned(whole_numbers(b.column("q_vec"), scale), pivots)
            d = _distances(np.concatenate([rows, np.zeros((len(rows), 1))], 1), np.concatenate([p, lifted[:, -1:]], 1))
            # The stored copy of the query has the lifted component; that one says which annulus is home.
            home = _distances(_lifted(rows, top), np.concatenate([p, lifted[:, -1:]], 1))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array((rows * rows).sum(1)), pa.array(d.tolist(), pa.list_(pa.float64())),
                 pa.array(home.argmin(1).astype(np.int32)), pa.array(home.min(1))],
                names=[*b.schema.names, "q_size", "q_dist", "home", "home_dist"])

    asked = held.where(F.expr(f"id % {int(every)} = 0")).select(
        F.col("row").alias("q_row"), F.col("id").alias("q_id"), F.col("vec").alias("q_vec"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    queries = saved(asked.withColumn("block", F.expr(f"pmod(xxhash64(q_row), {blocks})").cast("int")).mapInArrow(
        reach, extended(asked.schema, "block int, q_size double, q_dist array<double>, home int, home_dist double")), "topk-queries")
    rings = index.select("annulus", "pivot", "lo", "hi")
    at_home = F.expr("home = pivot and home_dist >= lo and home_dist <= hi")
    wide = queries.select("*", F.posexplode("q_dist").alias("p", "d"))
    cols = ["annulus", "block", "q_row", "q_id", "q_vec"]
    first = wide.where("p = home").join(rings, F.col("p") == F.col("pivot")).where(at_home).select(*cols)
    begun = saved(_scored(first, index, k, scale), "topk-first")
    floor = (_first(begun, k).groupBy("q_row").agg(F.min("score").alias("least"), F.count("*").alias("n"))
             .where(F.col("n") == k).select("q_row", "least"))
    gap = F.greatest(F.lit(0.0), F.col("lo") - F.col("d"), F.col("d") - F.col("hi"))
    bound = (F.col("q_size") + top - gap * gap) / 2 + 1e-6 * (1 + F.col("q_size") + top)
    rest = (wide.join(floor, "q_row", "left").join(rings, F.col("p") == F.col("pivot"))
            .where(~at_home & (F.col("least").isNull() | (bound >= F.col("least")))).select(*cols))
    found = begun.unionByName(_scored(rest, index, k, scale))
    return _first(found, k).select(F.col("q_id").alias("query_id"), F.col("rank").cast("int").alias("rank"),
                                   F.col("id").alias("vec_id"), "score")
