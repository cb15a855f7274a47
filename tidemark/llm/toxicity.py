"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are words and the 5- and 6-byte n-grams of words (a leading blank marks the
word's start).  The labelled examples are a bounded sample: at most ``EXAMPLES``
distinct texts of each label, those with the smallest hashes, so rare toxic texts
are all there; each example weighs what its label's texts do outside the sample.
Terms that go with either label are chosen on the sample by a chi-square test whose
false discoveries are held to ``DISCOVERY``, however many pass; their document
frequencies are counted over all documents.

The examples form a block-max inverted index: postings by term, examples in
blocks, and the largest weight of each term in each block it occurs in.  A batch of
queries adds up block bounds, opens each query's most promising blocks, and then
exactly those whose bound reaches its k-th similarity, so its neighbours are exact.
Neighbours vote with the square of their similarity; the prior counts as one weak
neighbour, which makes the score a share between 0 and 1.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import as_bytes, crc_remainder, extended, mixed, own_columns, pieces, saved, word_hashes, words_of

EXAMPLES = 2048      # distinct texts of each label at most
DISCOVERY = 0.01     # share of chosen terms that go with a label by chance
CHI_STEP = 0.125
CHI_STEPS = 1 << 14
LEAST_TEXTS = 4      # sampled texts that a term must stand in
COUNTED = 1 << 20    # counts of terms that a task holds before it hands them on
GRAMS = (5, 6)
NEIGHBOURS = 16
BLOCK = 64
FIRST_BLOCKS = 2     # that a query opens before it has a k-th similarity
PRIOR = 0.25
THRESHOLD = 0.3
TEXT_CHUNK = 1 << 18
ROWS = 256
QUERIES = 256        # scored together at most
POSTINGS = 1 << 20   # looked at together at most, but for a single query
FILTER_BITS = 18
TASK_ROWS = 1 << 12    # rows to score in a task, at least

_TO_SPACE = np.arange(256, dtype=np.uint8)
_TO_SPACE[[i for i in range(128) if not chr(i).isalnum()]] = 32
_VALUES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def terms(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text, term hash) arrays, one for words and one for each n-gram size; whole texts."""
    data, begins = as_bytes([None if t is None else t.lower() for t in texts], lower=True)
    data = np.concatenate([np.array([32], np.uint8), _TO_SPACE[data]])
    begins = begins + 1
    starts, ends = words_of(data)
    out = [(np.searchsorted(begins, starts, "right") - 1, word_hashes(data, starts, ends))]
    blanks = np.cumsum(data == 32)
    with np.errstate(over="ignore"):
        for n in GRAMS:
            # All bytes but the first must be inside a word; the first may be the blank before it.
            at = np.flatnonzero(blanks[n - 1:] == blanks[: len(data) - n + 1]) if len(data) >= n else np.empty(0, np.int64)
            h = np.full(len(at), np.uint64(n))
            for k in range(n):
                h = (h + _VALUES[data[at + k]]) * _STEP
            out.append((np.searchsorted(begins, at + 1, "right") - 1, mixed(h)))
    return out


def _distinct(owner: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, term) pairs in order, with counts."""
    order = np.lexsort((term, owner))
    owner, term = owner[order], term[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])
    first = np.flatnonzero(new)
    return owner[first], term[first], np.diff(np.append(first, len(owner)))


def _summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, toxic texts, texts) with every term once."""
    term, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    pos, every = (np.bincount(inverse, weights=np.concatenate([p[k] for p in parts]), minlength=len(term)) for k in (1, 2))
    return term, pos, every


def choose_terms(sample: DataFrame, p: int, n: int) -> np.ndarray:
    """Hashes of the terms that go with a label, toxic or clean, from (text, toxic) of distinct texts: ``p`` of ``n`` are toxic.

    Benjamini and Hochberg's step-up rule over all terms of LEAST_TEXTS texts or
    more; the cut comes from counts by steps of chi-square, CHI_STEPS rows at most.
    """
    def count(batches):
        parts, size = [], 0
        for whole in batches:
            marks = whole.column("toxic").to_numpy(zero_copy_only=False)
            done = 0
            for _, texts in pieces(whole, TEXT_CHUNK, ROWS):
                z, done = slice(done, done + len(texts)), done + len(texts)
                found = [_distinct(o, t) for o, t in terms(texts)]
                owner, term = (np.concatenate([f[k] for f in found]) for k in (0, 1))
                parts.append(_summed([(term, marks[z][owner], np.ones(len(term)))]))
                size += len(parts[-1][0])
                if size > COUNTED:
                    parts = [_summed(parts)]
                    size = len(parts[0][0])
                    if size > COUNTED // 2:
                        yield from handed_on(parts[0])
                        parts, size = [], 0
        if parts:
            yield from handed_on(_summed(parts))

    def handed_on(counts):
        term, pos, every = counts
        for a in range(0, len(term), 1 << 16):
            z = slice(a, a + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (term[z].view(np.int64), pos[z].astype(np.int64), every[z].astype(np.int64))],
                                             names=["term", "pos", "n"])

    if not p or p == n:
        return np.empty(0, np.uint64)
    a, k = F.col("a").cast("double"), F.col("k").cast("double")
    chi = F.lit(float(n)) * F.pow(a * n - k * p, 2) / (k * (n - k) * F.lit(float(p)) * (n - p))
    counts = saved(sample.select("text", "toxic").mapInArrow(count, "term long, pos long, n long").groupBy("term").agg(
        F.sum("pos").alias("a"), F.sum("n").alias("k")).where((F.col("k") < n) & (F.col("k") >= LEAST_TEXTS)).select("term", chi.alias("chi")), "toxicity-chi")
    steps = counts.groupBy(F.least(F.floor(F.col("chi") / CHI_STEP), F.lit(CHI_STEPS)).alias("step")).agg(F.count("*").alias("n")).collect()
    tests, rank, cut = sum(r["n"] for r in steps), 0, math.inf
    for r in sorted(steps, reverse=True):
        rank += r["n"]
        if math.erfc(math.sqrt(r["step"] * CHI_STEP / 2)) * tests <= DISCOVERY * rank:
            cut = r["step"] * CHI_STEP
    rows = counts.where(F.col("chi") >= cut).select("term").toArrow()  # bounded by the sample
    return np.sort(rows.column("term").to_numpy().view(np.uint64))


def _hits(texts: list, chosen: np.ndarray, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(where each text's terms begin, positions of chosen terms in order, counts)."""
    mask = np.uint64((1 << FILTER_BITS) - 1)
    owners, found = [], []
    for owner, term in terms(texts) if len(chosen) else []:
        hit = np.flatnonzero(maybe[(term & mask).astype(np.int64)])
        at = np.minimum(np.searchsorted(chosen, term[hit]), len(chosen) - 1)
        right = chosen[at] == term[hit]
        owners.append(owner[hit[right]])
        found.append(at[right])
    empty = np.empty(0, np.int64)
    owner, term, n = _distinct(np.concatenate([*owners, empty]), np.concatenate([*found, empty]))
    return np.searchsorted(owner, np.arange(len(texts) + 1)), term, n


def _filter(chosen: np.ndarray) -> np.ndarray:
    maybe = np.zeros(1 << FILTER_BITS, bool)
    maybe[(chosen & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
    return maybe


def with_terms(docs: DataFrame, chosen: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep``, ids (positions of the text's chosen terms, in order) and counts for each row."""
    maybe = _filter(chosen)

    def run(batches):
        for whole in batches:
            for part, texts in pieces(whole, TEXT_CHUNK, ROWS):
                cuts, term, n = _hits(texts, chosen, maybe)
                cuts = pa.array(cuts.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.ListArray.from_arrays(cuts, pa.array(term.astype(np.int32))),
                     pa.ListArray.from_arrays(cuts, pa.array(n.astype(np.int32)))], names=[*keep, "ids", "counts"])

    return docs.select(*keep, "text").mapInArrow(run, extended(docs.select(*keep).schema, "ids array<int>, counts array<int>"))


def _frequencies(found: DataFrame, size: int) -> DataFrame:
    """(t, n): the number of rows that each term stands in, summed up within a partition first."""
    def count(batches):
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(b.column("ids").flatten().to_numpy(), minlength=size)
        t = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(df[t])], names=["t", "n"])

    return found.select("ids").mapInArrow(count, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for size[0] numbers, then those of the next span."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


class Index:
    """Block-max inverted index of weighted examples; a cell is the postings of one term in one block."""

    def __init__(self, examples: list[tuple[list[int], list[int], float, float]], idf: np.ndarray, prior: float, bare: float):
        self.idf, self.prior, self.bare = idf, prior, bare
        # Examples with the same strongest terms stand together, which keeps block bounds tight.
        examples = sorted(examples, key=lambda e: (sorted(((-idf[t], t) for t in e[0]))[:2], e[0], e[1]))
        self.toxic = np.array([e[2] for e in examples], float)
        self.clean = np.array([e[3] for e in examples], float)
        size = [len(e[0]) for e in examples]
        owner = np.repeat(np.arange(len(examples)), size)
        term = np.array([t for e in examples for t in e[0]], np.int64)
        weight = np.concatenate([self.vector(e[0], e[1]) for e in examples]) if examples else np.empty(0)
        order = np.lexsort((owner, term))
        term, self.owner, self.weight = term[order], owner[order], weight[order]
        self.first = np.searchsorted(term, np.arange(len(idf) + 1))
        self.blocks = -(-len(examples) // BLOCK)
        block = self.owner // BLOCK
        new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])) if len(term) else np.empty(0, np.int64)
        self.cell = np.append(new, len(term))
        self.cell_block = block[new]
        self.most = np.maximum.reduceat(self.weight, new) if len(new) else np.empty(0)
        self.cells = np.searchsorted(term[new], np.arange(len(idf) + 1))

    def vector(self, ids, counts) -> np.ndarray:
        w = np.log1p(np.asarray(counts, float)) * self.idf[ids]
        return w / np.sqrt((w * w).sum())

    def nearest_of(self, who: np.ndarray, ids: np.ndarray, q: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, example, similarity) of the ``NEIGHBOURS`` examples most similar to each of ``n`` queries, ties to the earlier example.

        The queries' terms stand one after another: query, term and weight.
        """
        width, size = len(self.toxic), self.cells[ids + 1] - self.cells[ids]
        at, asks, w = _spans(self.cells[ids], size), np.repeat(who, size), np.repeat(q, size)
        bound = np.bincount(asks * self.blocks + self.cell_block[at], weights=w * self.most[at], minlength=n * self.blocks).reshape(n, self.blocks)
        score = np.zeros(n * width)

        def open_(blocks):
            inside = blocks[asks, self.cell_block[at]]
            cell = at[inside]
            size = self.cell[cell + 1] - self.cell[cell]
            posting = _spans(self.cell[cell], size)
            np.add(score, np.bincount(np.repeat(asks[inside], size) * width + self.owner[posting],
                                      weights=np.repeat(w[inside], size) * self.weight[posting], minlength=len(score)), out=score)

        def least():
            rows = score.reshape(n, width)
            return np.partition(rows, width - NEIGHBOURS, axis=1)[:, width - NEIGHBOURS] if width > NEIGHBOURS else np.zeros(n)

        promising = np.zeros(bound.shape, bool)
        np.put_along_axis(promising, np.argsort(-bound, axis=1, kind="stable")[:, :FIRST_BLOCKS], True, axis=1)
        open_(promising)
        open_(~promising & (bound > 0) & (bound >= least()[:, None] - 1e-12))
        rows = score.reshape(n, width)
        who, best = np.nonzero((rows > 0) & (rows >= least()[:, None]))
        order = np.lexsort((best, -rows[who, best], who))
        who, best = who[order], best[order]
        near = np.arange(len(who)) - np.searchsorted(who, who) < NEIGHBOURS
        return who[near], best[near], rows[who[near], best[near]]

    def nearest(self, ids: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.nearest_of(np.zeros(len(ids), np.int64), np.asarray(ids), q, 1)[1:]

    def scores(self, cuts: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[list[dict]]]:
        """Each query's score, and similarity and toxic share of its nearest examples as evidence; query i has ids[cuts[i]: cuts[i + 1]]."""
        n = len(cuts) - 1
        out, evidence = np.full(n, self.bare), [[] for _ in range(n)]
        if not len(ids) or not self.blocks:
            return out, evidence
        who = np.repeat(np.arange(n), np.diff(cuts))
        w = np.log1p(counts.astype(float)) * self.idf[ids]
        w /= np.sqrt(np.bincount(who, weights=w * w, minlength=n))[who]
        work = np.concatenate([[0], np.cumsum(self.first[ids + 1] - self.first[ids])])[cuts]
        a = 0
        while a < n:
            b = min(max(a + 1, int(np.searchsorted(work, work[a] + POSTINGS, "right")) - 1), a + QUERIES, n)
            z = slice(cuts[a], cuts[b])
            if cuts[b] > cuts[a]:
                asks, best, similar = self.nearest_of(who[z] - a, ids[z], w[z], b - a)
                vote, every = similar * similar, self.toxic[best] + self.clean[best]
                toxic = np.bincount(asks, weights=vote * self.toxic[best], minlength=b - a) + PRIOR * self.prior
                out[a:b] = np.where(np.diff(cuts[a: b + 1]) > 0, toxic / (np.bincount(asks, weights=vote * every, minlength=b - a) + PRIOR), out[a:b])
                rank = np.arange(len(asks)) - np.searchsorted(asks, asks)
                for i, s, share in zip((asks[rank < 3] + a).tolist(), similar[rank < 3].tolist(), (self.toxic[best] / every)[rank < 3].tolist()):
                    evidence[i].append({"similarity": s, "toxic": share})
            a = b
        return out, evidence


EVIDENCE = pa.list_(pa.struct([("similarity", pa.float64()), ("toxic", pa.float64())]))


def _examples(sample: DataFrame, chosen: np.ndarray, weights: dict[int, float]) -> list[tuple[list[int], list[int], float, float]]:
    """(ids, counts, toxic weight, clean weight) of each distinct term vector of the sample, the empty one too."""
    out: dict = {}
    for r in with_terms(sample, chosen, ["key", "toxic"]).select("ids", "counts", "toxic").collect():  # at most 2 x EXAMPLES rows
        out.setdefault((tuple(r["ids"]), tuple(r["counts"])), [0.0, 0.0])[1 - r["toxic"]] += weights[r["toxic"]]
    return [(list(ids), list(counts), t, c) for (ids, counts), (t, c) in sorted(out.items())]


def score(docs: DataFrame, labels: DataFrame, folds: int = 4, held_fold: int = 2, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", payload: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence for every document; with ``payload`` also ``doc``, the row itself.

    Labels are learned from documents whose crc32 of the id as text is not
    ``held_fold`` modulo ``folds``; a document, or a text, labelled more than once
    is toxic if any label says so, null labels and ids are not learned from.  A
    document without any chosen term (null and empty texts too) scores the share of
    toxic ones among examples without any.  Without labels of both classes every
    score is that share, or 0.  Repeated rows are scored alike; an empty table gives
    no rows; further columns are ignored.
    """
    doc = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if payload else []
    held = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), *doc)
    marks = own_columns(labels, of=id_col, toxic=label_col).where("of is not null and toxic is not null")
    marks = marks.groupBy("of").agg(F.max((F.col("toxic").cast("int") != 0).cast("int")).alias("toxic"))
    learnt = marks.where(crc_remainder("of", folds) != held_fold)
    # Distinct labelled texts are chosen by hash alone; only the chosen ones' texts move.
    keyed = held.where("text is not null").select("id", "text", F.xxhash64("text").alias("key"))
    known = saved(keyed.select("id", "key").join(learnt, F.col("id") == F.col("of")).groupBy("key").agg(F.max("toxic").alias("toxic")), "toxicity-labelled")
    total = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = saved(known.where("toxic = 1").orderBy("key").limit(EXAMPLES).union(known.where("toxic = 0").orderBy("key").limit(EXAMPLES)), "toxicity-picked")
    sample = saved(keyed.select("key", "text").join(F.broadcast(picked), "key").dropDuplicates(["key"]), "toxicity-sample")  # 2 x EXAMPLES rows broadcast
    taken = {c: min(n, EXAMPLES) for c, n in total.items()}
    n, every = sum(taken.values()), sum(total.values())
    weights = {c: (total[c] / every) / (taken[c] / n) for c in total}
    prior = total.get(1, 0) / every if every else 0.0
    chosen = choose_terms(sample, taken.get(1, 0), n)
    found = saved(with_terms(held, chosen, ["id"]), "toxicity-terms")
    rows = found.count()
    df = np.zeros(len(chosen), np.int64)
    for r in _frequencies(found, len(chosen)).collect():  # one row for each chosen term
        df[r["t"]] = r["n"]
    examples = _examples(sample, chosen, weights)
    bare = next(((t, c) for ids, _, t, c in examples if not ids), (0.0, 0.0))
    index = Index([e for e in examples if e[0]], np.log((1 + rows) / (1 + df)) + 1, prior, (bare[0] + PRIOR * prior) / (sum(bare) + PRIOR))
    maybe = _filter(chosen)

    def judged(part, cuts, ids, counts):
        scores, evidence = index.scores(cuts, ids, counts)
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(scores), pa.array(evidence, EVIDENCE)], names=[*keep, "score", "evidence"])

    def by_terms(batches):
        for b in batches:
            ids, counts = b.column("ids"), b.column("counts")
            cuts = np.asarray(ids.offsets).astype(np.int64)
            yield judged(b, cuts - cuts[0], np.asarray(ids.flatten()).astype(np.int64), np.asarray(counts.flatten()))

    def by_texts(batches):
        for b in batches:
            for part, texts in pieces(b, TEXT_CHUNK, ROWS, text_col):
                yield judged(part, *_hits(texts, chosen, maybe))

    # With whole rows the terms are found once more, which is cheaper than keeping a second copy of the texts.
    keep = ["doc"] if payload else ["id"]
    # Term lists are few bytes but many similarities: they are dealt evenly by rows, not by file size.
    tasks = min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + rows // TASK_ROWS)
    asked = held.select("doc") if payload else found.repartition(tasks)
    schema = extended(asked.select(*keep).schema, "score double, evidence array<struct<similarity: double, toxic: double>>")
    scored = asked.mapInArrow(by_texts if payload else by_terms, schema)
    of = F.col("doc").getField(id_col) if payload else F.col("id")
    scored = scored.withColumn("id", of)
    return scored.select(F.col("id").alias(id_col), (crc_remainder("id", folds) == held_fold).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence", *(["doc"] if payload else []))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns.

    Every row is judged by itself: null and empty texts, repeated rows and null ids
    like in ``score``; without labels of both classes every row stays; an empty table
    stays empty; columns of any type and name pass through.
    """
    return score(docs, labels, payload=True).where("predicted = 0").select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
