"""Secrets by patterns, and by a battery of randomness tests over everything that looks like a token.

Patterns find secrets that announce themselves.  Every other run of token
characters is read in the smallest encoding that holds it (digits, hex, base32,
letters, letters and digits, base64) and tested three ways there:

* chi-squared: do the encoding's symbols stand equally often?
* runs: do the symbols change between classes (digits, capitals, small letters;
  halves of the alphabet where there is one class only) as often as they should?
* serial correlation: does a symbol say anything about the next one?

A token must pass all three as a random string would, and must not look like
ordinary writing: each statistic also has a distribution under ordinary text,
whose symbol and pair frequencies are counted over the whole corpus, and Fisher's
method joins the three probabilities that ordinary text looks as random as the
token.  Thousands of tokens are tested, so the joint probabilities of one encoding
and length band form a family, cut by Benjamini and Hochberg's step-up rule: a
short token, of which there are many and whose tests are weak, needs more evidence
than a long one.  Strings that ordinary text writes at random too (plain
numbers) never stand out.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import pieces, saved

# The patterns whose matches are secrets, and the least length of the group that counts.
KINDS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)
HEX = re.compile(r"[0-9a-f]{16,}")  # the same matches as the hex pattern's that are long enough
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
DIGITS, SMALL = "0123456789", "abcdefghijklmnopqrstuvwxyz"
# The encodings, the smallest alphabet first; symbols in the order of their value.
ENCODINGS = (
    ("decimal", DIGITS), ("hex", DIGITS + SMALL[:6]), ("HEX", DIGITS + SMALL[:6].upper()), ("small", SMALL), ("capital", SMALL.upper()),
    ("base32", SMALL.upper() + "234567"), ("small-digits", DIGITS + SMALL), ("capital-digits", DIGITS + SMALL.upper()),
    ("letters", SMALL.upper() + SMALL), ("letters-digits", DIGITS + SMALL.upper() + SMALL),
    ("base64", SMALL.upper() + SMALL + DIGITS + "+/"), ("base64url", SMALL.upper() + SMALL + DIGITS + "-_"),
)
BANDS = (16, 20, 24, 32, 48, 64, 128)  # least lengths of the families
STRANGE = 3e-3      # a random token fails each of its tests as rarely as this
DISCOVERY = 0.01    # false share among a family's findings
BIN = 0.25          # of -log10 p
MOST_BIN = 400
TEXT_CHUNK = 1 << 18
ROWS = 256


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches, in order of start, then of kind."""
    found = []
    low = text.lower()
    if any(n in low for n in NAMES):
        found += [(m.start(), m.end(), 0) for m in KINDS[0][1].finditer(text) if len(m[KINDS[0][2]]) >= KINDS[0][3]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in KINDS[1][1].finditer(text) if len(m[0]) >= KINDS[1][3]]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return [(a, b, KINDS[k][0]) for a, b, k in sorted(found, key=lambda f: (f[0], f[2]))]


class Encoding:
    """An alphabet, and what ordinary text does in it."""

    def __init__(self, name: str, symbols: str, pairs: np.ndarray):
        self.name, self.size = name, len(symbols)
        code = np.frombuffer(symbols.encode(), np.uint8)
        self.value = np.full(128, -1)
        self.value[code] = np.arange(self.size)
        kind = np.array([1 if c.isdigit() else 2 if c.isupper() else 3 if c.islower() else 4 for c in symbols])
        if len(set(kind)) == 1:
            kind = (np.arange(self.size) * 2 >= self.size).astype(int)
        self.kind = kind
        share = np.bincount(kind) / self.size
        self.turn = 1 - (share * share).sum()  # of random neighbours
        # Ordinary text: pairs of neighbours that both are in the alphabet, one of each kind added so that none is impossible.
        pair = pairs[np.ix_(code, code)] + 1.0 / self.size
        p = pair.sum(1) / pair.sum()
        self.twice, self.thrice = (p * p).sum(), (p * p * p).sum()
        self.own_turn = pair[kind[:, None] != kind[None, :]].sum() / pair.sum()
        v, w = np.arange(self.size), pair / pair.sum()
        q = w.sum(0)
        a, b = v - (p * v).sum(), v - (q * v).sum()
        self.own_serial = float(a @ w @ b / math.sqrt(max(1e-12, (p * a * a).sum() * (q * b * b).sum())))

    def tests(self, symbols: np.ndarray) -> tuple[float, float]:
        """(the least probability of the three statistics in a random string, the joint one in ordinary text)."""
        v = self.value[symbols]
        n, k = len(v), self.size
        count = np.bincount(v, minlength=k)
        equal = float((count * (count - 1)).sum()) / 2  # chi-squared is 2 k / n times this, and n (k / n) - n more
        chi = k / n * float((count * count).sum()) - n
        # The variance of chi-squared over n equally likely draws of k symbols.
        random = [two_sided((chi - (k - 1)) / math.sqrt(2.0 * (k - 1) * (n - 1) / n))]
        choose = n * (n - 1) / 2
        spread = choose * self.twice * (1 - self.twice) + n * (n - 1) * (n - 2) * max(0.0, self.thrice - self.twice**2)
        ordinary = [below((equal + 0.5 - choose * self.twice) / math.sqrt(max(spread, 1e-9)))]
        turns = int((self.kind[v[1:]] != self.kind[v[:-1]]).sum())
        random.append(two_sided(deviation(turns, n - 1, self.turn)))
        # Random strings turn oftener than ordinary ones, or (halves of one class) perhaps more seldom.
        z = deviation(turns, n - 1, self.own_turn)
        ordinary.append(below(-z) if self.turn >= self.own_turn else below(z))
        x = v - v.mean()
        square = float((x * x).sum())
        serial = float((x[1:] * x[:-1]).sum()) / square if square else 1.0
        serial += 1 / n  # its mean in random strings is -1 / n
        random.append(two_sided(serial * math.sqrt(n)))
        z = (serial - self.own_serial) * math.sqrt(n)
        ordinary.append(below(z) if self.own_serial >= 0 else below(-z))
        return min(random), joint(ordinary)


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def below(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def deviation(turns: int, n: int, share: float) -> float:
    """Standard deviations, half a turn nearer its mean."""
    off = turns - n * share
    off = math.copysign(max(0.0, abs(off) - 0.5), off)
    return off / math.sqrt(max(n * share * (1 - share), 1e-9))


def joint(ps: list[float]) -> float:
    """Fisher's probability of independent ones."""
    half = -sum(math.log(max(p, 1e-300)) for p in ps)
    term = total = 1.0
    for i in range(1, len(ps)):
        term *= half / i
        total += term
    return min(1.0, math.exp(-half) * total)


def inferred(token: str) -> int | None:
    """The first (smallest) encoding that has all the token's characters; None where no encoding has."""
    letters = set(token)
    return next((i for i, (_, symbols) in enumerate(ENCODINGS) if letters <= SETS[i]), None)


SETS = [frozenset(s) for _, s in ENCODINGS]


def family(encoding: int, length: int) -> int:
    return encoding * len(BANDS) + int(np.searchsorted(BANDS, length, "right")) - 1


def pair_counts(docs: DataFrame) -> np.ndarray:
    """(128, 128) counts of neighbouring ASCII characters over all texts: summed in the partition, at most 2^14 rows to the driver."""
    def count(batches):
        total = np.zeros(1 << 14, np.int64)
        for b in batches:
            for _, texts in pieces(b, TEXT_CHUNK, ROWS):
                x = np.frombuffer("\n".join(t or "" for t in texts).encode(), np.uint8)
                both = (x[:-1] < 128) & (x[1:] < 128)
                total += np.bincount(x[:-1][both].astype(np.int64) << 7 | x[1:][both], minlength=1 << 14)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    out = np.zeros(1 << 14)
    for r in docs.select("text").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out.reshape(128, 128)


def tested(text: str, encodings: list[Encoding], taken: list[tuple[int, int, str]]) -> list[tuple[int, int, int, float]]:
    """(start, end, family, -log10 p) of each token outside the patterns' matches; 0 where a random string would look otherwise."""
    out, k = [], 0
    for m in TOKEN.finditer(text):
        a, b = m.span()
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if any(s < b and e > a for s, e, _ in taken[k:k + 4]):
            continue
        token = m[0].rstrip("=")
        if (e := inferred(token)) is None:
            continue
        random, ordinary = encodings[e].tests(np.frombuffer(token.encode(), np.uint8))
        out.append((a, b, family(e, len(token)), 0.0 if random < STRANGE else -math.log10(max(ordinary, 1e-300))))
    return out


def cuts(rows: list[tuple[int, int, int]], share: float) -> dict[int, float]:
    """The least -log10 p that counts in each family, from (family, bin, n): p <= share * rank / tests at a bin's lower edge."""
    out = {}
    for f in {r[0] for r in rows}:
        bins = sorted(((b, n) for g, b, n in rows if g == f), reverse=True)
        tests, rank = sum(n for _, n in bins), 0
        for b, n in bins:
            rank += n
            if b and tests * 10.0 ** (-b * BIN) <= share * rank:
                out[f] = b * BIN
    return out


def scan(docs: DataFrame, share: float = DISCOVERY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base (the patterns' spans) and spans (those and the method's), each start, end, kind, in order; code points, ends exclusive.

    A pattern's span is its whole match.  The method's spans have the kind
    ``random``, are 16 characters or longer and overlap none of the patterns'.
    ``share`` is the false share among the method's findings of an encoding and
    length band.  Null and empty texts have no spans; repeated rows are scanned
    alike (and count as often in the corpus's statistics); null ids are kept; an
    empty table gives no rows; further columns are ignored.
    """
    held = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    pairs = pair_counts(held)

    def run(batches):
        encodings = [Encoding(name, symbols, pairs) for name, symbols in ENCODINGS]
        for whole in batches:
            for part, texts in pieces(whole, TEXT_CHUNK, ROWS):
                base = [base_spans(t) if t else [] for t in texts]
                tokens = [tested(t, encodings, s) if t else [] for t, s in zip(texts, base)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([[dict(zip(("start", "end", "kind"), s)) for s in of] for of in base], SPANS),
                     pa.array([[dict(zip(("start", "end", "family", "evidence"), s)) for s in of] for of in tokens], TOKENS)],
                    names=["id", "base", "tokens"])

    found = saved(held.mapInArrow(run, f"id {held.schema['id'].dataType.simpleString()}, base {SPAN_DDL}, "
                                       "tokens array<struct<start:int,end:int,family:int,evidence:double>>"), "secret-spans")
    counts = (found.select(F.explode("tokens").alias("t")).groupBy(
        F.col("t.family").alias("family"), F.least(F.floor(F.col("t.evidence") / BIN), F.lit(MOST_BIN)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n")).collect())  # at most families x (MOST_BIN + 1) rows
    limits = cuts([(r["family"], r["bin"], r["n"]) for r in counts], share)

    def counts_as_secret(t: Column) -> Column:
        some = F.lit(False)
        for f, least in sorted(limits.items()):
            some = some | ((t["family"] == f) & (t["evidence"] >= least))
        return some

    added = F.transform(F.filter("tokens", counts_as_secret), lambda t: F.struct(t["start"], t["end"], F.lit("random").alias("kind")))
    order = F.array(*[F.lit(k[0]) for k in KINDS], F.lit("random"))
    ranked = F.array_sort(F.transform(F.concat("base", added), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("k"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return found.select(F.col("id").alias(id_col), "base", F.transform(ranked, lambda s: F.struct(s["start"], s["end"], s["kind"])).alias("spans"))


SPAN_DDL = "array<struct<start:int,end:int,kind:string>>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
TOKENS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("family", pa.int32()), ("evidence", pa.float64())]))


def written(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
