"""URL filters: a bit-parallel wildcard automaton over canonical URLs.

All rules are packed into one Shift-And automaton over several 64-bit words.
State bit i of a rule says that its first i symbols have been matched; a byte c
moves every bit of every rule at once: D = (shift(D) & enter[c]) | (D & stay[c]),
where ``stay`` holds the wildcards that may swallow c.  A batch of URLs is walked
side by side, one byte of each URL at a time.

The canonical URL is "." + host + path, so that a rule for a host is the glob
``*.host/path**``: ``*`` stands for any run of bytes other than "/", ``**`` for
any run at all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import extended

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = "(?s)^.*?://([^/?#]*)([^?#]*)"

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Hosts that are blocked where no rule fits.
DEFAULT_BLOCK = ("*casino**", "*-bets.**", "*-pills.**", "*.adult-**", "*.spam-**", "*.ads-**")


def symbols(glob: str) -> list[int | str]:
    """Bytes to match, ``*`` and ``**``."""
    out: list[int | str] = []
    parts = glob.split("*")
    for i, part in enumerate(parts):
        out += list(part.encode())
        if i + 1 < len(parts):
            if out and out[-1] == "*" and not part:
                out[-1] = "**"
            else:
                out.append("*")
    return out


def rule_symbols(host: str, path: str) -> list[int | str]:
    return ["*", *f".{host}{path}".encode(), "**"]


class Automaton:
    """Globs as bit masks; ``accepted`` says which of them match whole texts."""

    def __init__(self, rules: list[list[int | str]]):
        sizes = [1 + sum(not isinstance(s, str) for s in r) for r in rules]
        first = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
        self.words = max(1, -(-int(first[-1]) // 64))
        self.enter = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.last = [int(f + n - 1) for f, n in zip(first, sizes)]
        for rule, at in zip(rules, first.tolist()):
            self._set(self.start, at)
            for s in rule:
                if s == "**":
                    self._set(self.stay, at)
                elif s == "*":
                    self._set(self.stay, at, [c for c in range(256) if c != 0x2F])
                else:
                    at += 1
                    self._set(self.enter, at, [s])

    def _set(self, masks: np.ndarray, bit: int, symbols: list[int] | None = None) -> None:
        rows = masks if masks.ndim == 1 else masks[slice(None) if symbols is None else symbols]
        rows[..., bit // 64] |= np.uint64(1 << bit % 64)
        if symbols is not None:
            masks[symbols] = rows

    def accepted(self, texts: list[bytes]) -> np.ndarray:
        """(text, rule) matrix of matches."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-sizes, kind="stable")
        data = np.frombuffer(b"".join(texts) + b" ", np.uint8)
        begin, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        state = np.tile(self.start, (len(texts), 1))
        alive = np.searchsorted(-sizes, -np.arange(int(sizes.max(initial=0))), "left")  # texts longer than each place
        for place, n in enumerate(alive.tolist()):
            c, d = data[begin[:n] + place], state[:n]
            moved = d << np.uint64(1)
            moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.enter[c]) | (d & self.stay[c])
        out = np.empty((len(texts), len(self.last)), bool)
        for k, bit in enumerate(self.last):
            out[order, k] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) != 0
        return out


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, SPLIT, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, SPLIT, 2), F.lit(""))


def judge(pages: DataFrame, rules=RULES, default_block=DEFAULT_BLOCK, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, pattern for every row.

    The longest rule that fits decides (ties: the first listed); where none
    fits, a matching default glob blocks and ``pattern`` names it, else the page
    is allowed.  A null or malformed url has empty host and path and is allowed.
    Repeated rows and null ids are judged like others; further columns are ignored.
    """
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    names = [h + p for _, h, p in ranked]
    verdicts = [v for v, _, _ in ranked]
    machine = Automaton([rule_symbols(h, p) for _, h, p in ranked] + [symbols(g) for g in default_block])
    held = pages.select(pages[id_col].alias("id"), host(pages[url_col]).alias("host"), path(pages[url_col]).alias("path"))
    schema = extended(held.schema, "rule string, verdict string, pattern string")

    def run(batches):
        for b in batches:
            texts = [f".{h}{p}".encode() for h, p in zip(b.column("host").to_pylist(), b.column("path").to_pylist())]
            hit = machine.accepted(texts)
            n = len(names)
            pick = lambda part: np.where(part.any(1), part.argmax(1), -1).tolist() if part.shape[1] else [-1] * len(texts)
            rule, glob = pick(hit[:, :n]), pick(hit[:, n:])
            verdict = [verdicts[r] if r >= 0 else "block" if g >= 0 else "allow" for r, g in zip(rule, glob)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([names[r] if r >= 0 else None for r in rule], pa.string()), pa.array(verdict, pa.string()),
                 pa.array([default_block[g] if g >= 0 and r < 0 else None for r, g in zip(rule, glob)], pa.string())],
                names=[*b.schema.names, "rule", "verdict", "pattern"])

    judged = held.mapInArrow(run, schema)
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", "verdict", "pattern")
