"""Packing documents into windows with a non-negative least squares plan.

Documents are tokenised once and saved.  Whole windows are cut off the front; the
remainders, 1 to window - 1 tokens each, form a histogram of bounded size, all
that reaches the driver.  Shallow combinations of lengths that fill a window
exactly (all pairs, and triples of the most frequent lengths) are enumerated,
their repeat counts solved against the histogram by non-negative least squares,
and rounded down to what the histogram holds.  What is left is packed greedily:
laid end to end by length and cut where a window is full, the last, part-filled
window at powers of two.  So nearly every sequence is full, and only documents on
a window's border are cut.

A remainder's place follows from its length and its rank among remainders of that
length, by arithmetic on the plan.  Ranks are counted per input partition while
tokenising and shifted by a prefix sum over partitions; no length, however
frequent, is gathered in one task.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tidemark.llm.common import LOWER, as_bytes, extended, pieces, saved, word_hashes, words_of

WINDOW = 4096
TRIPLE_LENGTHS = 256
ROUNDS = 300
TEXT_CHUNK = 1 << 18
ROWS = 256
CACHE = 48 << 20     # bytes of known words at most
# Characters that the tokenizer sets apart at a word's end; neither apostrophes nor < | >.
PUNCTUATION = np.isin(np.arange(256), list(b"!\"#$%&()*+,-./:;=?@[]^_`{}~"))
ALNUM = np.array([chr(i).isalnum() and i < 128 for i in range(256)])
SMALL_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+")  # a to z, U+00E0 to U+00FF but the division sign

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs a task on each core

_TOKENIZERS: dict[str, "_Words"] = {}


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for size[0] numbers, then those of the next span."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


class _Words:
    """Tokenises texts word by word, each distinct word once.

    The tokenizer lower-cases, drops white space and never joins what it
    separates, so a text's ids are its words' ids in order.  ASCII punctuation at
    the end of a word is a token run of its own there, so it is split off first:
    far fewer distinct words remain.  Known words are found by a 64-bit hash and
    compared letter by letter; one whose hash belongs to another word is tokenised
    anew each time.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # A word of small letters that no normal form changes is one run to the tokenizer: its model can be asked directly.
        stands_for = ByteLevel(add_prefix_space=False, use_regex=False)
        self.merge = self.tokenizer.model.tokenize
        self.letters = {i: "".join(x for x, _ in stands_for.pre_tokenize_str(chr(i))) for i in range(0xE0, 0x100)}
        self.forget()

    def forget(self) -> None:
        self.keys, self.slot = np.empty(0, np.uint64), np.empty(0, np.int32)  # in order of the hashes
        self.first = self.size = self.letter = self.length = np.empty(0, np.int32)  # of each slot
        self.flat, self.text = np.empty(0, self.kind), np.empty(0, np.uint8)

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, as numbers of ``kind``."""
        data, begins = as_bytes(texts, lower=False)
        if b"<|" not in data.tobytes():  # else a lower-cased word could become a special token
            data = LOWER[data]
        starts, ends = words_of(data)
        split = self._cores(data, starts, ends)
        starts, ends = np.sort(np.concatenate([starts, split])), np.sort(np.concatenate([ends, split]))
        unique, where, inverse = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if sum(x.nbytes for x in (self.keys, self.slot, self.first, self.size, self.letter, self.length, self.flat, self.text)) > CACHE:
            self.forget()
        at = np.searchsorted(self.keys, unique)
        fresh = at == len(self.keys)
        fresh[~fresh] = self.keys[at[~fresh]] != unique[~fresh]
        if fresh.any():
            raw = data.tobytes()
            self._learn(unique[fresh], at[fresh], [raw[a:b] for a, b in zip(starts[where[fresh]].tolist(), ends[where[fresh]].tolist())])
        at = self.slot[np.searchsorted(self.keys, unique)][inverse]
        size, flat, first = self.size[at], self.flat, self.first[at].astype(np.int64)
        other = self._others(data, starts, ends, at)
        if len(other):
            raw = data.tobytes()
            anew = [self._encoded(raw[starts[i]: ends[i]]) for i in other.tolist()]
            size[other] = [len(x) for x in anew]
            first[other] = len(flat) + np.cumsum(size[other]) - size[other]
            flat = np.concatenate([flat, *(np.array(x, self.kind) for x in anew)])
        total = np.cumsum(size, dtype=np.int64)
        flat = flat[_spans(first, size.astype(np.int64))]
        word = np.searchsorted(starts, np.append(begins, len(data)))
        cut = np.concatenate([[0], total])[word]
        return [flat[a:b] for a, b in zip(cut[:-1], cut[1:])]

    def _cores(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where punctuation at a word's end begins, for words that have some behind a letter or digit."""
        at = np.flatnonzero(PUNCTUATION[data[ends - 1]])
        core, begin, out = ends[at] - 1, starts[at], []
        while len(core):
            inside = core > begin
            core, begin = core[inside], begin[inside]
            more = PUNCTUATION[data[core - 1]]
            out.append(core[~more])
            core, begin = core[more] - 1, begin[more]
        split = np.concatenate([*out, np.empty(0, np.int64)])
        return split[ALNUM[data[split - 1]]]

    def _others(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The words whose letters are not those of the known word with their hash."""
        length = (ends - starts).astype(np.int64)
        same = length == self.length[at]
        some = np.flatnonzero(same)
        apart = data[_spans(starts[some], length[some])] != self.text[_spans(self.letter[at[some]].astype(np.int64), length[some])]
        if apart.any():
            same[some[np.searchsorted(np.cumsum(length[some]), np.flatnonzero(apart), "right")]] = False
        return np.flatnonzero(~same)

    def _encoded(self, word: bytes) -> list[int]:
        text = word.decode()
        if SMALL_LETTERS.fullmatch(word):
            return [t.id for t in self.merge(text if text.isascii() else text.translate(self.letters))]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, keys: np.ndarray, at: np.ndarray, words: list[bytes]) -> None:
        ids = [self._encoded(w) for w in words]
        size, length = (np.fromiter(map(len, x), np.int32, len(x)) for x in (ids, words))
        self.slot = np.insert(self.slot, at, np.arange(len(self.size), len(self.size) + len(words), dtype=np.int32))
        self.keys = np.insert(self.keys, at, keys)
        self.first, self.letter, self.size, self.length = (np.concatenate(x, dtype=np.int32) for x in (
            (self.first, len(self.flat) + np.cumsum(size) - size), (self.letter, len(self.text) + np.cumsum(length) - length),
            (self.size, size), (self.length, length)))
        self.flat = np.concatenate([self.flat, np.fromiter(itertools.chain.from_iterable(ids), self.kind, int(size.sum()))])
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(words), np.uint8)])


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Saved rows (id, ids, n, part, full, rest, rank, full_before); ids are little-endian unsigned integers.

    rank counts earlier remainders of the same length in the partition, and
    full_before the whole windows of earlier documents in it.
    """
    def run(batches):
        words = _TOKENIZERS.get(tokenizer) or _TOKENIZERS.setdefault(tokenizer, _Words(tokenizer))
        kind = words.kind if end_id < 1 << 16 else np.dtype("<u4")
        end = np.array([end_id], kind).tobytes()
        context = TaskContext.get()
        part, seen, fulls = context.partitionId() if context else 0, np.zeros(window, np.int64), 0
        for whole in batches:
            for some, texts in pieces(whole, TEXT_CHUNK, ROWS):
                ids = [x.astype(kind, copy=False).tobytes() + end for x in words.ids(texts)]
                n = np.fromiter(map(len, ids), np.int64, len(ids)) // kind.itemsize
                full, rest = n // window, n % window
                order = np.argsort(rest, kind="stable")
                rank = np.empty(len(n), np.int64)
                rank[order] = np.arange(len(n)) - np.searchsorted(rest[order], rest[order])
                rank += seen[rest]
                seen += np.bincount(rest, minlength=window)
                before = fulls + np.cumsum(full) - full
                fulls += int(full.sum())
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), pa.array(ids, pa.binary()), pa.array(n),
                     pa.array(np.full(len(n), part, np.int32)), pa.array(full), pa.array(rest.astype(np.int32)), pa.array(rank), pa.array(before)],
                    names=["id", "ids", "n", "part", "full", "rest", "rank", "full_before"])

    held = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = extended(held.select("id").schema, "ids binary, n long, part int, full long, rest int, rank long, full_before long")
    return saved(held.mapInArrow(run, schema), "packing-tokens")


def combinations(histogram: np.ndarray) -> np.ndarray:
    """(m, 3) lengths that add up to the window; 0 stands for no third part."""
    window = len(histogram)
    a = np.arange(1, window // 2 + 1)
    pairs = np.stack([window - a, a, np.zeros_like(a)], 1)
    heavy = np.sort(np.argsort(-histogram, kind="stable")[:TRIPLE_LENGTHS])
    heavy = heavy[histogram[heavy] > 0]
    x, y = (v.ravel() for v in np.meshgrid(heavy, heavy))
    z = window - x - y
    fits = (x >= y) & (y >= z) & (z > 0)
    triples = np.stack([x[fits], y[fits], z[fits]], 1)
    every = np.concatenate([pairs, triples])
    return every[(histogram[every] > 0).sum(1) == (every > 0).sum(1)]


def repeats(histogram: np.ndarray, combos: np.ndarray) -> np.ndarray:
    """Non-negative least squares: x >= 0 minimising |A x - histogram|, by accelerated projected gradient."""
    want = histogram.astype(float)
    want[0] = 0

    def made(x):
        out = np.bincount(combos.ravel(), weights=np.repeat(x, 3), minlength=len(want))
        out[0] = 0
        return out

    def back(r):
        return r[combos].sum(1)

    v = np.ones(len(combos))
    for _ in range(30):  # the largest eigenvalue of A'A
        v = back(made(v))
        largest = np.linalg.norm(v)
        v /= largest
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(ROUNDS):
        nxt = np.maximum(0, y - back(made(y) - want) / (1.05 * largest))
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        x, y = nxt, nxt + (before - 1) / t * (nxt - x)
    return x


class Plan:
    """Where the remainder of a given length and rank goes."""

    def __init__(self, histogram: np.ndarray, first_sequence: int):
        self.window = len(histogram)
        left = histogram.astype(np.int64).copy()
        left[0] = 0
        runs: list[list[tuple[int, int, int]]] = [[] for _ in left]  # (ranks, sequence, offset) of each length
        sequence = first_sequence
        combos = combinations(left)
        if len(combos):
            x = np.rint(repeats(left, combos)).astype(np.int64)
            for i in np.argsort(-x, kind="stable").tolist():
                parts = [p for p in combos[i].tolist() if p]
                n = min([int(x[i]), *(int(left[p]) // parts.count(p) for p in parts)])
                if n <= 0:
                    continue
                offset = 0
                for p in parts:
                    runs[p].append((n, sequence, offset))
                    left[p] -= n
                    offset += p
                sequence += n
        size = np.arange(self.window)
        self.stream = np.cumsum(left * size) - left * size  # where the residue of each length begins
        total = int((left * size).sum())
        self.sequence, tail = sequence, total // self.window * self.window
        bounds = [tail]  # of the part-filled window, cut at powers of two
        for bit in reversed(range(self.window.bit_length())):
            if total - tail >> bit & 1:
                bounds.append(bounds[-1] + (1 << bit))
        self.tail = np.array(bounds, np.int64)
        self.ends = [np.cumsum([r[0] for r in run]).astype(np.int64) for run in runs]
        self.runs = runs

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(length, sequence, offset) of each piece."""
        ends = self.ends[length]
        k = int(np.searchsorted(ends, rank, "right"))
        taken = int(ends[k - 1]) if k else 0
        if k < len(ends):
            _, sequence, offset = self.runs[length][k]
            return [(length, sequence + rank - taken, offset)]
        at = int(self.stream[length]) + (rank - taken) * length
        out, stop = [], at + length
        while at < stop:
            if at < self.tail[0]:
                sequence, begin = self.sequence + at // self.window, at // self.window * self.window
                end = begin + self.window
            else:
                j = int(np.searchsorted(self.tail, at, "right")) - 1
                sequence, begin, end = self.sequence + int(self.tail[0]) // self.window + j, int(self.tail[j]), int(self.tail[j + 1])
            n = min(stop, end) - at
            out.append((n, sequence, at - begin))
            at += n
        return out


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ids (little-endian uint32) on request.

    Every document is its token ids and ``end_id``; a null or empty text is that
    one id alone.  Null ids and repeated rows are packed like others; an empty
    table gives no rows; further columns are ignored.
    """
    tokens = tokenised(docs, tokenizer, end_id, window, id_col, text_col)
    by_part = tokens.groupBy("part", "rest").agg(F.count("*").alias("k"), F.sum("full").alias("f"))
    by_part = saved(by_part, "packing-counts")
    rows = by_part.groupBy("rest").agg(F.sum("k").alias("k"), F.sum("f").alias("f")).collect()  # at most ``window`` rows
    histogram = np.zeros(window, np.int64)
    for r in rows:
        histogram[r["rest"]] = r["k"]
    plan = Plan(histogram, sum(r["f"] for r in rows))
    earlier = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = by_part.groupBy("part").agg(F.sum("f").alias("f")).withColumn(
        "first_full", F.coalesce(F.sum("f").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def listed(t: pa.Table) -> pa.Table:
        first = np.zeros(window, np.int64)
        first[t.column("rest").to_numpy()] = t.column("first_rank").to_numpy()
        return pa.table({"part": t.column("part").slice(0, 1), "first_rank": [first]})

    # One row a partition, not one a partition and length; beyond Spark's broadcast threshold the join shuffles by partition.
    ranks = by_part.withColumn("first_rank", F.coalesce(F.sum("k").over(earlier), F.lit(0))).select("part", "rest", "first_rank")
    shifts = ranks.groupBy("part").applyInArrow(listed, "part int, first_rank array<long>").join(ahead.select("part", "first_full"), "part")
    placed = tokens.join(saved(shifts, "packing-shifts"), "part").select(
        "id", "ids", "n", "full", "rest", (F.col("rank") + F.element_at("first_rank", F.col("rest") + 1)).alias("rank"),
        (F.col("full_before") + F.col("first_full")).alias("first_full"))
    schema = extended(tokens.select("id").schema, "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
                      + (", ids binary" if with_ids else ""))

    def run(batches):
        for b in batches:
            out, source = [[] for _ in range(7)], []
            columns = [b.column(c).to_pylist() for c in ("ids", "n", "full", "rest", "rank", "first_full")]
            for k, (raw, n, full, rest, rank, first) in enumerate(zip(*columns)):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                parts = [(window, first + i, 0) for i in range(full)] + (plan.pieces(rest, rank) if rest else [])
                at = 0
                for length, sequence, offset in parts:
                    own = ids[at: at + length].tobytes()
                    source.append(k)
                    for column, value in zip(out, (at, length, zlib.crc32(own), n, sequence, offset, own)):
                        column.append(value)
                    at += length
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(source, pa.int64())), *(pa.array(c, pa.int64()) for c in out[:6]),
                 *([pa.array(out[6], pa.binary())] if with_ids else [])], names=[f.name for f in schema])

    packed = placed.mapInArrow(run, schema)
    return packed.select(F.col("id").alias(id_col), *[f.name for f in schema if f.name != "id"])
