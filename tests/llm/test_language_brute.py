"""Language identification against a plain computation of n-grams, weights, centroids, floors and the nearest centroid."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from tidemark.llm import language_id
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
M = 0xFFFFFFFF


def grams(text):
    """Bucket -> count over the letters' 1-, 2- and 3-grams, one blank between and around words."""
    z = [0]
    for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
        z += [ord(c) for c in word] + [0]
    keys = [c * 0x9E3779B1 for c in z if c]
    keys += [a * 0x9E3779B1 + b * 0x85EBCA77 + 1 for a, b in zip(z, z[1:])]
    keys += [a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D + 2 for a, b, c in zip(z, z[1:], z[2:]) if b]
    out = Counter()
    for h in keys:
        h &= M
        h ^= h >> 15
        out[(h * 0x2C1B3C6D & M) >> 20] += 1
    return out


def vector(text, idf):
    v = np.zeros(4096)
    for b, n in grams(text).items():
        v[b] = math.log1p(n) * idf[b]
    return v / (np.linalg.norm(v) or 1), int((v > 0).sum())


def clusters(x):
    seeds = [sum(x) / len(x)]
    while len(seeds) < min(4, len(x)):
        seeds.append(min(x, key=lambda v: max(v @ s for s in seeds)))
    for _ in range(12):
        seeds = [s / np.linalg.norm(s) for s in seeds]
        own = [max(range(len(seeds)), key=lambda k: v @ seeds[k]) for v in x]
        seeds = [np.mean([v for v, o in zip(x, own) if o == k], axis=0) if k in own else s for k, s in enumerate(seeds)]
    return [s / np.linalg.norm(s) for s in seeds]


def band(n):
    return sum(n >= edge for edge in (8, 16, 32, 64, 128, 256, 512, 1024, 2048))


def test_query_is_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    held = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0 for d in docs}
    texts = defaultdict(set)
    for d in docs:
        if not held[d["doc_id"]] and d["lang"] is not None and d["text"] is not None:
            texts[d["lang"]].add(d["text"])
    assert max(map(len, texts.values())) <= language_id.SAMPLE  # so the sample is every text
    df, n = Counter(), 0
    for some in texts.values():
        for t in some:
            df.update(grams(t).keys())
            n += 1
    idf = [math.log((1 + n) / (1 + df[b])) + 1 for b in range(4096)]
    centroids, floors = {}, {}
    for lang, some in texts.items():
        found = [f for f in (vector(t, idf) for t in some) if f[1]]
        centroids[lang] = np.array(clusters([v for v, _ in found]))
        found += [vector(t[:k], idf) for k in (4, 8, 16, 32, 64, 128, 256, 512, 1024) for t in some if len(t) > k]
        near = defaultdict(list)
        for v, g in found:
            if g:
                near[band(g)].append((centroids[lang] @ v).max())
        floors[lang], last = [], 0.0
        for k in range(10):
            last = 0.8 * float(np.quantile(near[k], 0.005)) if len(near[k]) >= 20 else last
            floors[lang].append(last)

    got = {r["doc_id"]: r for r in QUERIES["op4_language_id"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r = got[d["doc_id"]]
        assert r["held_out"] == held[d["doc_id"]]
        v, g = vector(d["text"], idf)
        if not g:
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        best = {lang: float((c @ v).max()) for lang, c in centroids.items()}
        score = max(best.values())
        assert abs(best[r["lang_pred"]] - score) < 1e-5 and abs(r["score"] - score) < 1e-5
        floor = floors[r["lang_pred"]][band(g)]
        assert abs(score - floor) < 1e-5 or r["rejected"] == (score < floor)


def test_counts_do_not_depend_on_the_batch():
    some = ["Hello world", "", "été à Paris", None, "   ", "a", "42", "x y\nz", "ПРИВЕТ мир!"]
    alone = np.concatenate([language_id.counted([t]) for t in some])
    assert (language_id.counted(some) == alone).all() and (language_id.counted(some[::-1]) == alone[::-1]).all()
    for t, row in zip(some, alone):
        assert {int(b): int(row[b]) for b in np.flatnonzero(row)} == dict(grams(t))
