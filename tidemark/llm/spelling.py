"""Spelling variants by a bit-sliced position index over the vocabulary.

For each position and letter one bitset says which vocabulary words have that
letter there.  A query word is read letter by letter over whole machine words of
vocabulary at a time: ``zero`` holds the words that agree so far, ``one`` those
with one replaced letter, ``extra`` those that have had one letter more (its
letters are looked up one position further on).  What is left in ``one`` and
``extra`` after the last letter are the words one edit away; words with a letter
less find their partner from the shorter side.

Two words of at least six letters that are one edit apart share their first three
letters or their last three: the edit can't touch both.  So the vocabulary is
dealt by first and by last letters; each pair comes up on one side only, decided
by whether the first letters agree.  Buckets that are too large are cut into parts,
and every two parts meet in a group of their own.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import saved

RUN = re.compile("[A-Za-zÀ-ÿ]{6,}")
LEAST_LETTERS = 6    # the affix argument needs twice AFFIX letters
AFFIX = 3
HELD = 1 << 17       # distinct words that a task counts before it hands them on
BUCKET = 1 << 12     # words a bucket, about
PART = 1 << 17       # letters in a part of a bucket, about
STRIP = 256          # queries read together
TIMES = 5            # a form stands this many times as often as the word


def counted(docs: DataFrame, least: int, typo_every: int, id_col: str, text_col: str) -> DataFrame:
    """(word, n) of words with at least LEAST_LETTERS letters and ``least`` occurrences."""
    def count(batches):
        n: dict[str, int] = {}
        for b in batches:
            ids = b.column("id").to_pylist()
            for i, of in enumerate(ids):
                text = b.column("text")[i].as_py()
                if not text:
                    continue
                runs = RUN.findall(text.encode().lower().decode())  # bytes.lower() changes A-Z alone
                own = {}
                for w in runs:
                    own[w] = own.get(w, 0) + 1
                begun = zlib.crc32(f"{'' if of is None else of}:".encode())
                for w, k in own.items():
                    h = zlib.crc32(w.encode(), begun)
                    if typo_every and not h % typo_every:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                    n[w] = n.get(w, 0) + k
                if len(n) > HELD:
                    yield from handed_on(n)
                    n = {}
        yield from handed_on(n)

    def handed_on(n):
        words = [w for w in n if len(w) >= LEAST_LETTERS]
        for i in range(0, len(words), 1 << 14):
            part = words[i: i + (1 << 14)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([n[w] for w in part], pa.int64())], names=["word", "n"])

    held = docs.select(docs[id_col].cast("string").alias("id"), docs[text_col].alias("text"))
    return held.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class PositionIndex:
    """Bitsets over words of one length: bit j of ``bits[i, c]`` says that word j has letter c at position i."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        letters = np.unique(words)
        self.place = np.full(256, len(letters), np.int64)  # letters that no word has: the empty set
        self.place[letters] = np.arange(len(letters))
        span = -(-self.n // 64)
        self.bits = np.zeros((words.shape[1], len(letters) + 1, span), np.uint64)
        for i in range(words.shape[1]):
            has = np.zeros((len(letters), span * 64), bool)
            has[self.place[words[:, i]], np.arange(self.n)] = True
            self.bits[i, :-1] = np.packbits(has, axis=1, bitorder="little").view(np.uint64)

    def one_replaced(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) pairs that differ in exactly one letter; queries have the words' length."""
        def read(at):
            zero, one = np.full((len(at), self.bits.shape[2]), ~np.uint64(0)), np.zeros((len(at), self.bits.shape[2]), np.uint64)
            for i in range(at.shape[1]):
                agree = self.bits[i][at[:, i]]
                one = (one & agree) | (zero & ~agree)
                zero &= agree
            return one
        return self._strips(queries, read)

    def one_longer(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) pairs in which the word is the query and one letter more."""
        def read(at):
            zero = np.full((len(at), self.bits.shape[2]), ~np.uint64(0))
            extra = zero.copy()
            for i in range(at.shape[1]):
                zero &= self.bits[i][at[:, i]]
                extra = (extra & self.bits[i + 1][at[:, i]]) | zero
            return extra
        return self._strips(queries, read)

    def _strips(self, queries, read):
        found = []
        for i in range(0, len(queries), STRIP):
            left = read(self.place[queries[i: i + STRIP]])
            q, w = np.nonzero(left)
            if len(q):
                some, bit = np.nonzero(np.unpackbits(left[q, w][:, None].view(np.uint8), axis=1, bitorder="little"))
                word = w[some] * 64 + bit
                real = word < self.n  # the last machine word has bits beyond the words
                found.append((q[some][real] + i, word[real]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(f) for f in zip(*found))


def near_pairs(words: list[bytes], part: np.ndarray, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """Unordered pairs of words one edit apart, each once; ``across`` only those of different parts (0 and 1)."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    by_length = {}
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        by_length[n] = at, np.frombuffer(b"".join(words[i] for i in at.tolist()), np.uint8).reshape(len(at), n), part[at]
    left, right = [], []
    for n, (at, rows, side) in by_length.items():
        for s in (0, 1) if across else (None,):
            asked = np.ones(len(at), bool) if s is None else side == s
            if s != 1:
                held = np.ones(len(at), bool) if s is None else side == 1
                if asked.any() and held.any():
                    q, w = PositionIndex(rows[held]).one_replaced(rows[asked])
                    q, w = at[asked][q], at[held][w]
                    left.append(q if across else q[q < w])
                    right.append(w if across else w[q < w])
            if n + 1 in by_length:
                more, longer, other = by_length[n + 1]
                held = np.ones(len(more), bool) if s is None else other != s
                if asked.any() and held.any():
                    q, w = PositionIndex(longer[held]).one_longer(rows[asked])
                    left.append(at[asked][q])
                    right.append(more[held][w])
    empty = np.empty(0, np.int64)
    return np.concatenate([*left, empty]), np.concatenate([*right, empty])


def _summaries(words: DataFrame) -> DataFrame:
    """(word, n_near, best): the number of near words, and the most frequent of them as (-n, word)."""
    buckets = 1 + words.count() // BUCKET
    dealt = words.select("word", "n", F.explode(F.array(
        F.struct(F.lit(True).alias("front"), F.substring("word", 1, AFFIX).alias("affix")),
        F.struct(F.lit(False).alias("front"), F.substring("word", -AFFIX, AFFIX).alias("affix")))).alias("of"))
    dealt = dealt.select("word", "n", F.col("of.front").alias("front"), F.pmod(F.xxhash64("of.affix"), F.lit(buckets)).cast("int").alias("bucket"))
    parts = dealt.groupBy("front", "bucket").agg((1 + F.floor(F.sum(F.length("word")) / PART)).cast("int").alias("parts"))
    cut = dealt.join(parts, ["front", "bucket"]).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "front", "bucket", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "word", "n")

    def group(t: pa.Table) -> pa.Table:
        front, a, b = (t.column(c)[0].as_py() for c in ("front", "a", "b"))
        t = t.sort_by("word")  # UTF-8 order is code point order
        text = t.column("word").to_pylist()
        words = [w.encode("latin-1") for w in text]
        n = t.column("n").to_numpy()
        x, y = near_pairs(words, (t.column("part").to_numpy() == b).astype(np.int64) if a != b else np.zeros(len(words), np.int64), a != b)
        same = np.array([words[i][:AFFIX] == words[j][:AFFIX] for i, j in zip(x.tolist(), y.tolist())], bool)
        x, y = x[same == front], y[same == front]
        x, y = np.concatenate([x, y]), np.concatenate([y, x])
        order = np.lexsort((y, -n[y], x))
        x, y = x[order], y[order]
        of, first, count = np.unique(x, return_index=True, return_counts=True)
        return pa.table({"word": pa.array([text[i] for i in of.tolist()], pa.string()), "n_near": pa.array(count, pa.int64()),
                         "near": pa.array([text[i] for i in y[first].tolist()], pa.string()), "near_n": pa.array(n[y[first]], pa.int64())})

    found = met.groupBy("front", "bucket", "a", "b").applyInArrow(group, "word string, n_near long, near string, near_n long")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("least"), "near")).alias("best"))


def variants(docs: DataFrame, least: int = 5, times: int = TIMES, typo_every: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the vocabulary.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of
    six letters or more that occur ``least`` times or more in whole texts.  A
    word's form is its most frequent near word (ties: the smallest in code point
    order) if that stands at least ``times`` times as often, else null; its root
    is where the forms lead.  ``typo_every`` plants errors: where it divides the
    crc32 of ``<id>:<run>``, the run loses the letter at crc32 % length.

    Null and empty texts have no words, a null id counts as empty text, repeated
    rows count as often as they stand.  An empty table gives no rows; further
    columns are ignored.
    """
    words = saved(counted(docs, least, typo_every, id_col, text_col), "spelling-words")
    near = saved(_summaries(words), "spelling-near")
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.least") >= times * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.least") >= times * F.col("n"), -F.col("best.least")).alias("form_n"))
    joined = saved(joined, "spelling-forms")
    # Counts grow along the forms, so chains end; each round doubles what a link spans.
    links = joined.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = saved(links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                           F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if not links.where("moved").limit(1).count():
            break
        links = links.drop("moved")
    return joined.join(links.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
