"""Language identification by nearest centroid over TF-IDF character n-grams.

A text is its letters in lower case, everything else one blank; its 1-, 2- and
3-grams are hashed into ``DIMENSIONS`` counts, damped, weighted by inverse
document frequency and scaled to length one.  Each language is a few spherical
k-means centroids of a bounded sample of labelled texts.  The language of the
nearest centroid by cosine is predicted; a text is marked rejected if its cosine is
below four fifths of what all but one in 200 of the language's own examples with as
many n-grams reach.  The beginnings of the examples count as examples of fewer n-grams.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import bounded_sample, crc_remainder, extended, pieces, saved

DIMENSIONS = 4096
SAMPLE = 800
CENTROIDS = 4
ROUNDS = 12
TEXT_CHUNK = 1 << 19
ROWS = 256
QUANTILE = 0.005
LEEWAY = 0.8         # for texts that are not among the examples
BEGINNINGS = (4, 8, 16, 32, 64, 128, 256, 512, 1024)  # characters of an example
BANDS = np.array([8, 16, 32, 64, 128, 256, 512, 1024, 2048])  # different n-grams of a text
LEAST_TEXTS = 20     # in a band, or the floor of the band of fewer n-grams holds
_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _bucket(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(32 - DIMENSIONS.bit_length() + 1)


def counted(texts: list[str | None]) -> np.ndarray:
    """(text, bucket) counts of the n-grams; a text without letters is a row of zeros."""
    lowered = [(t or "").lower() for t in texts]
    # Every text has a blank on either side, so its counts do not depend on the texts beside it.
    codes = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le"), "<u4")
    size = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    doc = np.concatenate([np.zeros(1, np.int64), np.repeat(np.arange(len(texts)), size)])[: len(codes)]
    z = np.where(_letters()[codes], codes, np.uint32(0))
    keep = np.ones(len(z), bool)
    keep[1:] = (z[1:] != 0) | (z[:-1] != 0)
    z, doc = z[keep], doc[keep]
    with np.errstate(over="ignore"):
        one, two, three = z * _A, z * _B, z * _C
        grams = [(z != 0, doc, one)]
        # A blank belongs to the text of its neighbour; blanks never touch after squeezing.
        if len(z) > 1:
            grams.append((np.ones(len(z) - 1, bool), np.where(z[:-1] != 0, doc[:-1], doc[1:]), one[:-1] + two[1:] + np.uint32(1)))
        if len(z) > 2:
            grams.append((z[1:-1] != 0, doc[1:-1], one[:-2] + two[1:-1] + three[2:] + np.uint32(2)))
        out = np.zeros(len(texts) * DIMENSIONS, np.int64)
        for keep, owner, h in grams:
            at = owner[keep] * DIMENSIONS + _bucket(h[keep])
            out += np.bincount(at, minlength=len(out))
    return out.reshape(len(texts), DIMENSIONS)


def vectors(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' vectors, and their numbers of different n-grams."""
    rows = np.log1p(counted(texts).astype(np.float32)) * idf
    size = np.sqrt((rows * rows).sum(1, keepdims=True))
    return rows / np.where(size > 0, size, 1), (rows > 0).sum(1)


def _floors(cosine: np.ndarray, grams: np.ndarray) -> list[float]:
    """For each band of n-grams, ``LEEWAY`` times the cosine that all but ``QUANTILE`` of the examples reach."""
    band, floors = np.searchsorted(BANDS, grams, "right"), []
    for k in range(len(BANDS) + 1):
        some = cosine[(band == k) & (grams > 0)]
        floors.append(LEEWAY * float(np.quantile(some, QUANTILE)) if len(some) >= LEAST_TEXTS else floors[-1] if floors else 0.0)
    return floors


def _centroids(x: np.ndarray) -> np.ndarray:
    """Spherical k-means from far-apart seeds."""
    seeds = [x.mean(0)]
    for _ in range(min(CENTROIDS, len(x)) - 1):
        seeds.append(x[(x @ np.array(seeds).T).max(1).argmin()])
    c = np.array(seeds)
    for _ in range(ROUNDS):
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        own = (x @ c.T).argmax(1)
        c = np.stack([x[own == k].mean(0) if (own == k).any() else c[k] for k in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)


def fit(train: DataFrame) -> dict:
    """The model from (text, lang): at most ``SAMPLE`` distinct texts of each language are used."""
    sample = saved(bounded_sample(train.where("lang is not null and text is not null"), "lang", "text", SAMPLE), "language-sample")

    def frequencies(batches):
        total, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for part, texts in pieces(batch, TEXT_CHUNK, ROWS):
                total, n = total + (counted(texts) > 0).sum(0), n + len(texts)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["n", "df"])

    # One row for each partition of the bounded sample.
    rows = sample.coalesce(16).mapInArrow(frequencies, "n long, df array<long>").collect()
    n, df = sum(r["n"] for r in rows), np.sum([r["df"] for r in rows], axis=0, dtype=np.int64) if rows else np.zeros(DIMENSIONS)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def cluster(table: pa.Table) -> pa.Table:
        texts = [t for b in table.to_batches() for _, t in pieces(b, TEXT_CHUNK, ROWS)]
        found = [vectors(t, idf) for t in texts]
        x, grams = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        x, grams = x[x.any(1)], grams[x.any(1)]
        c = _centroids(x) if len(x) else np.empty((0, DIMENSIONS), np.float32)
        floors = []
        if len(c):
            near = [((x @ c.T).max(1), grams)]
            for size in BEGINNINGS:
                for t in texts:
                    if cut := [v[:size] for v in t if len(v) > size]:
                        y, n = vectors(cut, idf)
                        near.append(((y @ c.T).max(1), n))
            floors = _floors(*(np.concatenate([f[k] for f in near]) for k in (0, 1)))
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(c), pa.string()),
                         "centroid": pa.array([r.astype("<f4").tobytes() for r in c], pa.binary()),
                         "floors": pa.array([floors] * len(c), pa.list_(pa.float64()))})

    found = sample.groupBy("lang").applyInArrow(cluster, "lang string, centroid binary, floors array<double>").orderBy("lang", "centroid").collect()
    return {"idf": idf, "langs": [r["lang"] for r in found], "floors": np.array([r["floors"] for r in found]),
            "centroids": np.array([np.frombuffer(r["centroid"], "<f4") for r in found], np.float32).reshape(len(found), DIMENSIONS)}


def predict(docs: DataFrame, model: dict, keep: list[str], payload_text: str | None = None) -> DataFrame:
    """``keep``, lang_pred, score (cosine, 0 to 1), rejected; docs has the column text.

    With ``payload_text`` the text is that field of the kept column doc, so it travels once.
    """
    langs, centroids, idf = np.array(model["langs"], object), model["centroids"], model["idf"]
    floors = model["floors"]

    def run(batches):
        for batch in batches:
            for part, texts in pieces(batch, TEXT_CHUNK, ROWS, payload_text):
                x, grams = vectors(texts, idf)
                some = grams > 0
                if len(langs):
                    cosine = x @ centroids.T
                    best = cosine.argmax(1)
                    score = np.clip(cosine[np.arange(len(x)), best], 0, 1).astype(float)
                    lang, rejected = langs[best], ~some | (score < floors[best, np.searchsorted(BANDS, grams, "right")])
                else:
                    lang, score, rejected = np.full(len(x), "und", object), np.zeros(len(x)), np.ones(len(x), bool)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(np.where(some, lang, "und").tolist(), pa.string()),
                     pa.array(np.where(some, score, 0.0)), pa.array(rejected)], names=[*keep, "lang_pred", "score", "rejected"])

    asked = docs.select(*keep) if payload_text else docs.select(*keep, "text")
    return asked.mapInArrow(run, extended(docs.select(*keep).schema, "lang_pred string, score double, rejected boolean"))


def identify(docs: DataFrame, folds: int = 5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             payload: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row; with ``payload`` also ``doc``, the row itself.

    Learns from rows whose crc32 of the id as text is not divisible by ``folds``
    and whose language is not null.  A null text, or one without letters, is
    ``und`` with score 0 and rejected; so is everything if nothing could be
    learned.  Repeated rows and null ids (fold of the empty text) are predicted
    like others; an empty table gives no rows; further columns are ignored.
    """
    doc = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if payload else []
    held = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang"), *doc)
    held = held.withColumn("held_out", crc_remainder("id", folds) == 0)
    model = fit(held.where("not held_out").select("text", "lang"))
    out = predict(held, model, ["id", "held_out", *(["doc"] if payload else [])], text_col if payload else None)
    return out.withColumnRenamed("id", id_col)


def identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns."""
    return identify(docs, payload=True).where("not rejected").select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
