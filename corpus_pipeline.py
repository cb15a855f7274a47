"""The corpus pipeline: five stages, each a saved table that the next one reads.

Toxic documents go, then documents in no known language, then all but one of
each group of SimHash near-duplicates; the rest is mixed to the sources' target
weights (a document taken twice stands twice) and packed into windows.  Every
stage sets the library's session settings, so that it may also be run alone.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import language_id, mixing, packing, simhash, toxicity
from tidemark.llm.common import saved
from tidemark.session import configure


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, configure(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return language_id.identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return simhash.one_of_each(docs, shingle_words=4, radius=4, stored=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return mixing.mixed_documents(docs, stored=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, window=4096, with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language ID", drop_unknown_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Neither the classifiers nor XXH64 fingerprints can be written in DuckDB SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
