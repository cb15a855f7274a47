"""Language model scores by a weighted backoff automaton over word pairs.

The model is a bigram model with interpolated absolute discounting.  Its states
are words; a pair seen in training is an arc with its weight, and every state has
a failure arc to the unigram state, taken when a pair was not seen.  A text is
walked once from left to right, the state being the last word.

Counting and scoring both work on blocks: a few megabytes of documents with their
words as 64-bit hashes.  A block sends each distinct pair once, with its count,
to the pair's bucket; the bucket adds the counts up and sends each block the
totals of its own pairs, in the order they came.  Words go the same way.  So a
block ends up with exactly the part of the automaton that its documents can
visit, and no task ever holds the model.  The number of buckets follows the
number of tokens; pairs are dealt by their left word, those of a word that would
fill a bucket alone by both words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import as_bytes, chunks, crc_remainder, extended, mixed, own_columns, saved, word_hashes, words_of

BLOCK_TEXT = 8 << 20
TEXT_CHUNK = 1 << 21
BUCKET_TOKENS = 1_000_000
START, END = np.uint64(1), np.uint64(2)
_K = np.uint64(0x9FB21C651E98DF25)


def _blocks(docs: DataFrame) -> DataFrame:
    """(block, ids, held, sizes, words, tokens): distinct word hashes and the documents' places in them, ends included."""
    def run(batches):
        context = TaskContext.get()
        key, text, held, count = (context.partitionId() if context else 0) << 32, 0, [], 0

        def block():
            ids = pa.concat_arrays([h[0] for h in held])
            sizes = np.concatenate([h[2] for h in held])
            words, tokens, often = np.unique(np.concatenate([h[3] for h in held]), return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")  # small numbers for frequent words
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            words, tokens = words[order], place[tokens]
            return pa.RecordBatch.from_arrays(
                [pa.array([key + count], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 pa.array([np.concatenate([h[1] for h in held]).tolist()], pa.list_(pa.bool_())), pa.array([sizes.tolist()], pa.list_(pa.int32())),
                 pa.array([words.tobytes()], pa.binary()), pa.array([_squeezed(tokens)], pa.binary()), pa.array([int(sizes.sum())], pa.int64())],
                names=["block", "ids", "held", "sizes", "words", "tokens", "n"])

        for batch in batches:
            texts, out = batch.column("text").to_pylist(), batch.column("held_out").to_numpy(zero_copy_only=False)
            for a, b in chunks(texts, TEXT_CHUNK):
                data, begins = as_bytes(texts[a:b], lower=True)
                starts, ends = words_of(data)
                first = np.searchsorted(starts, np.append(begins, len(data)))
                hashes = np.insert(word_hashes(data, starts, ends), first[1:], END)
                held.append((batch.column("id").slice(a, b - a), out[a:b], np.diff(first) + 1, hashes))
                text += len(data)
                if text >= BLOCK_TEXT:
                    yield block()
                    held, text, count = [], 0, count + 1
        if held:
            yield block()

    kind = docs.schema["id"].dataType.simpleString()
    return saved(docs.mapInArrow(run, f"block long, ids array<{kind}>, held array<boolean>, sizes array<int>, words binary, tokens binary, n long"), "lm-blocks")


class Block:
    """The words and pairs of one block, dealt to buckets; the same in every pass."""

    def __init__(self, words: bytes, tokens: bytes, sizes: list[int], held: list[bool], buckets: int):
        self.words, self.sizes = np.frombuffer(words, np.uint64), np.asarray(sizes, np.int64)
        self.token = _widened(tokens, int(self.sizes.sum())).astype(np.int64)
        self.held, self.buckets = np.asarray(held, bool), np.uint64(buckets)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.trained = np.repeat(~self.held, self.sizes)

    def dealt_words(self):
        """Order of the words by bucket, and each bucket's range in it."""
        bucket = self.words % self.buckets
        order = np.argsort(bucket, kind="stable")
        return order, np.searchsorted(bucket[order], np.arange(int(self.buckets) + 1))

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.token[self.trained], minlength=len(self.words)).astype(np.uint64)

    def pairs(self, hot: np.ndarray) -> None:
        """Distinct (left, right) pairs by bucket and left word; left is -1 at a document's start."""
        left = np.empty_like(self.token)
        left[1:] = self.token[:-1]
        left[self.first] = -1
        key = (left + 1) * len(self.words) + self.token
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        group = np.cumsum(new) - 1
        key = key[new]
        self.left, self.right = key // len(self.words) - 1, key % len(self.words)
        seen = np.bincount(group, weights=self.trained[order], minlength=len(key)).astype(np.uint64)
        self.left_hash = np.where(self.left < 0, START, self.words[self.left])
        self.right_hash = self.words[self.right]
        with np.errstate(over="ignore"):
            alone = _among(hot, self.left_hash)
            bucket = mixed(self.left_hash + np.where(alone, self.right_hash, np.uint64(0)) * _K) % self.buckets
        place = np.argsort(bucket, kind="stable")
        self.cuts = np.searchsorted(bucket[place], np.arange(int(self.buckets) + 1))
        self.left, self.right, self.seen = self.left[place], self.right[place], seen[place]
        self.left_hash, self.right_hash = self.left_hash[place], self.right_hash[place]
        spot = np.empty(len(key), np.int64)
        spot[place] = np.arange(len(key))
        self.of_token = np.empty(len(order), np.int64)
        self.of_token[order] = spot[group]


def _among(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)] == values


def _squeezed(values: np.ndarray) -> bytes:
    """Unsigned integers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _widened(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob, max_output_size=8 * n), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel()


def _narrow(hashes: np.ndarray) -> bytes:
    """The low 48 bits: enough to tell apart the words that follow one word."""
    return np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _broad(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


EXCHANGE = "bucket int, block long, n int, left binary, runs binary, right binary, seen binary"
RETURNED = "kind int, block long, bucket int, a binary, b binary, s0 long, s1 long, s2 long, s3 long"
PAIR_TOTALS, FOLLOWERS, STATISTICS, WORD_TOTALS, DOCUMENTS = range(5)


def _rows(rows: list[tuple]) -> pa.Table:
    kind, block, bucket, a, b, *s = zip(*rows) if rows else [()] * 9
    return pa.table({"kind": pa.array(kind, pa.int32()), "block": pa.array(block, pa.int64()), "bucket": pa.array(bucket, pa.int32()),
                     "a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), **{f"s{i}": pa.array(v, pa.int64()) for i, v in enumerate(s)}})


def _each_block(batch, buckets: int):
    for r in batch.to_pylist():
        yield r, Block(r["words"], r["tokens"], r["sizes"], r["held"], buckets)


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      names=["bucket", "block", "n", "left", "runs", "right", "seen"])


def _frequent(blocks: DataFrame, tokens: int) -> np.ndarray:
    """Sorted hashes of words that would fill a bucket alone: no more of them than there are buckets."""
    def count(batches):
        for batch in batches:
            for _, k in _each_block(batch, 1):
                n = np.bincount(k.token, minlength=len(k.words))
                own = np.flatnonzero(n * tokens >= len(k.token) * BUCKET_TOKENS)
                yield pa.RecordBatch.from_arrays([pa.array(k.words[own].view(np.int64)), pa.array(n[own])], names=["word", "n"])

    rows = (blocks.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= BUCKET_TOKENS).select("word").toArrow())
    return np.sort(np.append(rows.column("word").to_numpy().view(np.uint64), START))


def _pair_exchange(blocks: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    def send(batches):
        for batch in batches:
            for r, k in _each_block(batch, buckets):
                k.pairs(hot)
                out = []
                for i, (a, b) in enumerate(zip(k.cuts[:-1].tolist(), k.cuts[1:].tolist())):
                    if a < b:
                        left = k.left_hash[a:b]
                        run = np.flatnonzero(np.append(True, left[1:] != left[:-1]))
                        out.append((i, r["block"], b - a, left[run].tobytes(), _squeezed(np.diff(np.append(run, b - a))),
                                    _narrow(k.right_hash[a:b]), _squeezed(k.seen[a:b])))
                yield _sent(out)

    def add(table: pa.Table) -> pa.Table:
        bucket, sizes = table.column("bucket")[0].as_py(), table.column("n").to_pylist()
        left, right, seen = [], [], []
        for n, words, runs, follow, count in zip(sizes, *(table.column(c) for c in ("left", "runs", "right", "seen"))):
            word = np.frombuffer(words.as_buffer(), np.uint64)
            left.append(np.repeat(word, _widened(runs.as_py(), len(word)).astype(np.int64)))
            right.append(_broad(follow.as_py()))
            seen.append(_widened(count.as_py(), n))
        left, right, seen = (np.concatenate(v) for v in (left, right, seen))
        with np.errstate(over="ignore"):
            pair = mixed(left * _K ^ mixed(right))
        pair, first, inverse = np.unique(pair, return_index=True, return_inverse=True)
        total = np.bincount(inverse, weights=seen, minlength=len(pair)).astype(np.uint64)
        mine, at, rows = total[inverse], 0, []
        for block, n in zip(table.column("block").to_pylist(), sizes):
            rows.append((PAIR_TOTALS, block, bucket, _squeezed(mine[at: at + n]), None, 0, 0, 0, 0))
            at += n
        words, followers = np.unique(left[first[total > 0]], return_counts=True)
        home = words % np.uint64(buckets)
        for i in np.unique(home).tolist():
            own = home == i
            rows.append((FOLLOWERS, -1, i, words[own].tobytes(), _squeezed(followers[own]), 0, 0, 0, 0))
        rows.append((STATISTICS, -1, bucket, None, None, int((total == 1).sum()), int((total == 2).sum()), 0, 0))
        return _rows(rows)

    return saved(blocks.mapInArrow(send, EXCHANGE).groupBy("bucket").applyInArrow(add, RETURNED), "lm-pairs")


def _word_exchange(blocks: DataFrame, pairs: DataFrame, buckets: int) -> DataFrame:
    def send(batches):
        for batch in batches:
            for r, k in _each_block(batch, buckets):
                order, cuts = k.dealt_words()
                counts, out = k.word_counts(), []
                for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                    if a < b:
                        out.append((i, r["block"], b - a, k.words[order[a:b]].tobytes(), None, None, _squeezed(counts[order[a:b]])))
                starts = np.array([int((~k.held).sum())], np.uint64)
                out.append((int(START % np.uint64(buckets)), r["block"], 1, None, None, np.array([START]).tobytes(), _squeezed(starts)))
                yield _sent(out)

    def add(table: pa.Table) -> pa.Table:
        bucket, blocks_ = table.column("bucket")[0].as_py(), table.column("block").to_pylist()
        # left: a block's words; right alone: its start symbol, or (block -1) words with their numbers of followers.
        hashes, values, kinds = [], [], []
        for block, left, right, seen in zip(blocks_, *(table.column(c).to_pylist() for c in ("left", "right", "seen"))):
            h = np.frombuffer(left if left is not None else right, np.uint64)
            hashes.append(h)
            values.append(_widened(seen, len(h)))
            kinds.append(0 if left is not None else 1 if block >= 0 else 2)
        word, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        size = np.array([len(h) for h in hashes])
        kind, value = np.repeat(kinds, size), np.concatenate(values).astype(float)
        count = np.bincount(inverse, weights=np.where(kind < 2, value, 0), minlength=len(word)).astype(np.uint64)
        after = np.bincount(inverse, weights=np.where(kind == 2, value, 0), minlength=len(word)).astype(np.uint64)
        rows, ends = [], np.cumsum(size)
        for block, k, a, b in zip(blocks_, kinds, (ends - size).tolist(), ends.tolist()):
            if k < 2:  # the start symbol's row is marked by a negative bucket
                rows.append((WORD_TOTALS, block, bucket if k == 0 else -1, _squeezed(count[inverse[a:b]]), _squeezed(after[inverse[a:b]]), 0, 0, 0, 0))
        real = count[word != START]
        rows.append((STATISTICS, -1, bucket, None, None, int(real.sum()), int((real > 0).sum()), int((real == 1).sum()), int((real == 2).sum())))
        return _rows(rows)

    followers = pairs.where(F.col("kind") == FOLLOWERS).select(
        "bucket", "block", F.lit(0).alias("n"), F.lit(None).cast("binary").alias("left"), F.lit(None).cast("binary").alias("runs"),
        F.col("a").alias("right"), F.col("b").alias("seen"))
    return saved(blocks.mapInArrow(send, EXCHANGE).union(followers).groupBy("bucket").applyInArrow(add, RETURNED), "lm-words")


def _discount(once: int, twice: int) -> float:
    return min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5


def score(docs: DataFrame, folds: int = 7, held_fold: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document; whole texts.

    Learns from documents whose crc32 of the id as text is not ``held_fold``
    modulo ``folds``.  Tokens are white-space separated words, A-Z lower-cased,
    then one end.  All words not seen in training are one unknown token.  base
    is the add-one unigram score of the contract, score the automaton's log10
    probability.  A null or empty text is its end alone; without training text
    every token has probability one; repeated rows and null ids (fold of the
    empty text) take part like others; an empty table gives no rows; further
    columns are ignored.
    """
    held = own_columns(docs, id=id_col, text=text_col).withColumn("held_out", crc_remainder("id", folds) == held_fold)
    blocks = _blocks(held)
    every = blocks.agg(F.sum("n")).first()[0] or 0
    buckets = max(8, -(-every // BUCKET_TOKENS))
    hot = _frequent(blocks, every)
    pairs = _pair_exchange(blocks, buckets, hot)
    words = _word_exchange(blocks, pairs, buckets)
    total = lambda df, n: [v or 0 for v in df.where(F.col("kind") == STATISTICS).agg(*[F.sum(f"s{i}") for i in range(n)]).first()]
    pair_discount = _discount(*total(pairs, 2))
    tokens, distinct, once, twice = total(words, 4)
    word_discount = _discount(once, twice)

    def walk(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        at = int(np.flatnonzero(kind == DOCUMENTS)[0])
        row = {c: table.column(c)[at].as_py() for c in ("a", "b", "held", "sizes")}
        k = Block(row["a"], row["b"], row["sizes"], row["held"], buckets)
        k.pairs(hot)
        order, cuts = k.dealt_words()
        seen = np.zeros(len(k.left), np.uint64)
        count, after = np.zeros(len(k.words) + 1, np.uint64), np.zeros(len(k.words) + 1, np.uint64)  # the last is the start
        for i in np.flatnonzero(kind != DOCUMENTS).tolist():
            bucket, a, b = (table.column(c)[i].as_py() for c in ("bucket", "a", "b"))
            if kind[i] == PAIR_TOTALS:
                x, y = k.cuts[bucket], k.cuts[bucket + 1]
                seen[x:y] = _widened(a, y - x)
            else:
                place = np.array([-1]) if bucket < 0 else order[cuts[bucket]: cuts[bucket + 1]]
                count[place], after[place] = _widened(a, len(place)), _widened(b, len(place))
        known = count[:-1] > 0
        if tokens:
            base = np.log10((count[:-1].astype(float) + 1) / (tokens + distinct + 1))
            single = np.where(known, count[:-1].astype(float) - word_discount, word_discount * distinct) / tokens
        else:
            base, single = np.zeros(len(k.words)), np.ones(len(k.words))
        # Arc weights: a pair's own share, then the failure arc of its state times the unigram arc.
        state = count[k.left].astype(float)
        lower = single[k.right]
        arc = np.where(state > 0, (np.maximum(seen.astype(float) - pair_discount, 0) + pair_discount * after[k.left].astype(float) * lower)
                       / np.maximum(state, 1), lower)
        add = lambda v: np.add.reduceat(v, k.first)
        n = len(k.sizes)
        return pa.table({
            "id": table.column("ids")[at].values, "held_out": pa.array(k.held), "n_tokens": pa.array(k.sizes),
            "n_known": pa.array(add(known[k.token].astype(np.int64))), "train_tokens": pa.array(np.full(n, tokens, np.int64)),
            "base_score": pa.array(add(base[k.token])), "score": pa.array(add(np.log10(arc)[k.of_token]))})

    nothing = [F.lit(None).cast(t).alias(c) for c, t in ((c, blocks.schema[c].dataType) for c in ("ids", "held", "sizes"))]
    shares = pairs.where(F.col("kind") == PAIR_TOTALS).union(words.where(F.col("kind") == WORD_TOTALS)).select("kind", "block", "bucket", "a", "b", *nothing)
    own = blocks.select(F.lit(DOCUMENTS).alias("kind"), "block", F.lit(0).alias("bucket"), F.col("words").alias("a"), F.col("tokens").alias("b"),
                        "ids", "held", "sizes")
    schema = extended(held.select("id").schema, "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return own.union(shares).groupBy("block").applyInArrow(walk, schema).withColumnRenamed("id", id_col)
