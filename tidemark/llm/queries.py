"""The registered query of each operator, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (embedding_dedup, exact_topk, hard_negatives, language_id, license_scan, lm_score, mixing, packing, secret_scan,
                          simhash, spelling, toxicity, url_filter)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.95)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"), folds=5)


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(_table(spark, sf_dir, "embeddings"), k=5, scale=256.0, every=50)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=4, radius=4)


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_table(spark, sf_dir, "documents"), folds=7, held_fold=2)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("sentence_ids").alias("n_sentences"), F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.array_join("licences", ",").alias("licences"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer, end_id=2, window=4096, with_ids=False)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), folds=4, held_fold=2)
    return found.select("doc_id", "held_out", "score", "predicted")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"), least=5, times=5, typo_every=199)


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    kinds = [F.size(F.filter("base", _of_kind(k[0]))).cast("long").alias(f"n_{k[0]}") for k in secret_scan.KINDS]
    return found.select("doc_id", *kinds, F.sha2(secret_scan.written("base"), 256).alias("base_sha256"), secret_scan.written("spans").alias("spans"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.expr("vec_id % 7 = 0"), (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    return hard_negatives.mine(vectors.select("vec_id", "embedding", label), positives=5, negatives=10, low=30, high=90, scale=256.0, every=100)


QUERIES = {f.__name__: f for f in (op1_embedding_dedup, op2_mixing, op3_url_filter, op4_language_id, op5_exact_topk, op6_simhash, op7_lm_score, op8_license_scan, op9_packing,
                                  op10_toxicity, op11_spelling_variants, op12_secret_scan, op13_hard_negatives)}

ORACLE = {
    # The given texts hold each licence sentence on a line of its own; the SQL reads lines.
    "op8_license_scan": """
        WITH line AS (SELECT doc_id, generate_subscripts(l, 1) AS k, lower(trim(unnest(l))) AS s
                      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
        hit AS (SELECT doc_id, k, CASE
                  WHEN regexp_full_match(s, 'licensed under the apache license, version 2\\.0\\.?') THEN 'apache-2-line'
                  WHEN regexp_full_match(s, 'released under the mit license\\.?') THEN 'mit-line'
                  WHEN regexp_full_match(s, 'this work is licensed under the gnu general public license, version 3\\.?') THEN 'gpl-3-line'
                  WHEN regexp_full_match(s, 'licensed under cc by-nc 4\\.0\\.?') THEN 'cc-by-nc-4-line'
                  WHEN regexp_full_match(s, 'all rights reserved\\.?') THEN 'reserved' END AS name FROM line),
        named AS (SELECT doc_id, k, name, CASE name WHEN 'apache-2-line' THEN 'Apache-2.0' WHEN 'mit-line' THEN 'MIT'
                  WHEN 'gpl-3-line' THEN 'GPL-3.0-only' WHEN 'cc-by-nc-4-line' THEN 'CC-BY-NC-4.0'
                  WHEN 'reserved' THEN 'proprietary' END AS licence FROM hit WHERE name IS NOT NULL)
        SELECT d.doc_id, count(n.name)::INTEGER AS n_sentences, coalesce(string_agg(n.name, ',' ORDER BY n.k), '') AS sentence_ids,
               coalesce(string_agg(n.licence, ',' ORDER BY n.k), '') AS licences
        FROM documents d LEFT JOIN named n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op1_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
                 ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
        reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
        n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
        SELECT v.vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(reach.b) AS component_id,
               min(reach.b) = v.vec_id AS kept
        FROM v JOIN reach ON reach.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id GROUP BY v.vec_id""",
    "op2_mixing": f"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                          md5(coalesce(doc_id::VARCHAR, '')) AS spot FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
        c AS (SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0) AS rest,
                     sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS share FROM w
              WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        f AS (SELECT *, rest * weight <= source_size * 3 * share AS fits FROM c),
        g AS (SELECT arg_min(rest, share * -1) AS rest1, max(share) AS share1 FROM f WHERE fits),
        t AS (SELECT source, source_size, CASE WHEN fits THEN (rest1 * weight)::DOUBLE / share1::DOUBLE
                     ELSE (source_size * 3)::DOUBLE END AS target FROM f, g),
        o AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
                     row_number() OVER (PARTITION BY d.source ORDER BY size, spot) AS pos
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        k AS (SELECT source, draw, ('0x' || substr(md5('mix' || draw || CASE WHEN source IS NULL THEN 'n' ELSE 's' END
                     || coalesce(source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS shift FROM t, range({mixing.DRAWS}) r(draw)),
        x AS (SELECT o.*, k.draw, k.shift, (floor(shift + rate * pos) - floor(shift + rate * (pos - 1)))::BIGINT * size AS taken
              FROM o JOIN k ON o.source IS NOT DISTINCT FROM k.source),
        m AS (SELECT source, draw, abs(sum(taken) - any_value(target)) AS miss FROM x GROUP BY source, draw),
        b AS (SELECT source, min({{'miss': miss, 'draw': draw}}) AS best FROM m GROUP BY source)
        SELECT doc_id, size, source_size, target, taken FROM x JOIN b ON x.source IS NOT DISTINCT FROM b.source AND x.draw = b.best.draw""",
    "op3_url_filter": """
        WITH p AS (SELECT page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
        r AS (SELECT *, CASE
                WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
                WHEN '.' || host LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
                WHEN '.' || host LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
                WHEN '.' || host LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule FROM p)
        SELECT page_id, host, path, rule, CASE
                WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                WHEN regexp_matches('.' || host, 'casino|-bets\\.|-pills\\.|\\.adult-|\\.spam-|\\.ads-') THEN 'block'
                ELSE 'allow' END AS verdict FROM r""",
    "op5_exact_topk": """
        WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS e FROM embeddings),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op13_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          [floor(256 * x::DOUBLE) for x in embedding] AS e
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, a.label AS own, c.vec_id, c.label, list_inner_product(a.e, c.e)::BIGINT AS score
              FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE own = label
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
                     row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
              FROM p JOIN s ON p.anchor_id = s.anchor_id AND own <> label
              WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}
