"""Toxicity against a brute-force version of the whole of it: terms, choice, idf, nearest examples, votes."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute_terms(text):
    t = "".join(" " if ord(c) < 128 and not c.isalnum() else c for c in (text or "").lower())
    data = b" " + t.encode()
    out = Counter(("word", w) for w in data.split(b" ") if w)
    for n in (5, 6):
        out.update((n, w) for i in range(len(data) - n + 1) if b" " not in (w := data[i: i + n])[1:])
    return out


def brute(docs, labels):
    """{doc: (score, certain)}; certain where no tie crosses the last neighbour."""
    marks = {}
    for of, toxic in labels:
        if of is not None and toxic is not None and zlib.crc32(str(of).encode()) % 4 != 2:
            marks[of] = max(marks.get(of, 0), toxic)
    label = {}
    for of, text in docs:
        if text is not None and of in marks:
            label[text] = max(label.get(text, 0), marks[of])
    found = {t: brute_terms(t) for t in {t for _, t in docs}}
    n, p = len(label), sum(label.values())
    a, k = Counter(), Counter()
    for t, toxic in label.items():
        k.update(set(found[t]))
        if toxic:
            a.update(set(found[t]))
    chi = {t: n * (a[t] * n - k[t] * p) ** 2 / (k[t] * (n - k[t]) * p * (n - p)) for t in k if 4 <= k[t] < n}
    steps = Counter(math.floor(c / 0.125) for c in chi.values())
    cuts = [s for s in steps if math.erfc(math.sqrt(s * 0.125 / 2)) * len(chi) <= 0.01 * sum(m for x, m in steps.items() if x >= s)]
    chosen = {t for t, c in chi.items() if cuts and c >= min(cuts) * 0.125}
    df = Counter(t for _, text in docs for t in found[text] if t in chosen)
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in chosen}

    def vector(text):
        v = {t: math.log1p(c) * idf[t] for t, c in found[text].items() if t in chosen}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}
    merged = {}
    for t, toxic in label.items():
        key = frozenset((x, c) for x, c in found[t].items() if x in chosen)
        merged.setdefault(key, [vector(t), 0, 0])[1 if toxic else 2] += 1
    empty = merged.pop(frozenset(), [0, 0, 0])
    prior, out = p / n, {}
    for of, text in docs:
        v = vector(text)
        if not v:
            out[of] = (empty[1] + 0.25 * prior) / (empty[1] + empty[2] + 0.25), True
            continue
        near = sorted(((sum(x * e.get(t, 0) for t, x in v.items()), toxic, clean) for e, toxic, clean in merged.values()), reverse=True)
        near = [x for x in near if x[0] > 0]
        certain = len(near) <= 16 or near[15][0] - near[16][0] > 1e-9
        vote = sum(s * s * t for s, t, _ in near[:16]), sum(s * s * (t + c) for s, t, c in near[:16])
        out[of] = (vote[0] + 0.25 * prior) / (vote[1] + 0.25), certain
    return out


def test_query_is_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").collect()]
    want = brute(docs, labels)
    got = QUERIES["op10_toxicity"](spark, SF).collect()
    assert len(got) == len(docs)
    sure = [r for r in got if want[r["doc_id"]][1]]
    assert len(sure) > 0.8 * len(got)
    for r in sure:
        assert r["score"] == pytest.approx(want[r["doc_id"]][0], abs=1e-9)
        assert r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_one_class_ties_and_rare_toxic_texts(spark, monkeypatch):
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('plain words number ', id) AS text").withColumn("extra", F.create_map(F.lit(1), F.lit(2)))
    clean = spark.range(40).selectExpr("id AS doc_id", "0 AS toxic")
    got = toxicity.score(docs, clean).collect()
    assert {(r["score"], r["predicted"]) for r in got} == {(0.0, 0)} and toxicity.accepted(docs, clean).count() == 40
    # A bound below the number of clean texts keeps every toxic one, and weighs the clean ones up.
    monkeypatch.setattr(toxicity, "EXAMPLES", 30)
    rows = [(i, "some quiet harmless words", 0) for i in range(50)] + [(100 + i, f"quiet garden {i} words", 0) for i in range(400)]
    rows += [(1000 + i, f"vilevilevile garden {i}", 1) for i in range(20)] + [(2000, "vilevilevile", None), (2001, "quiet garden", None), (2002, None, 1)]
    t = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(t.drop("toxic"), t.select("doc_id", "toxic")).collect()}
    assert got[2000]["predicted"] == 1 and got[2001]["predicted"] == 0 and got[2002]["predicted"] == 0


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(3)
    vectors = [sorted(rng.choice(60, rng.integers(1, 7), replace=False).tolist()) for _ in range(900)]
    index = toxicity.Index([(v, [1] * len(v), i % 3 == 0, i % 3 > 0) for i, v in enumerate(vectors)], rng.uniform(1, 4, 60), 0.3, 0.1)
    asked = vectors[:300] + [[]]
    cuts = np.concatenate([[0], np.cumsum([len(v) for v in asked])])
    flat = np.array([t for v in asked for t in v])
    every, _ = index.scores(cuts, flat, np.ones(len(flat), np.int64))
    for i in range(0, 301, 20):
        one, _ = index.scores(np.array([0, len(asked[i])]), np.array(asked[i], np.int64), np.ones(len(asked[i]), np.int64))
        assert one[0] == pytest.approx(every[i], abs=1e-12)
