"""A corpus pipeline: each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.llm import bpe, dedup, langid, minhash, mixing
from lakegauge.session import materialise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; fitted on those that are not held out. What the model rejects goes.

    A rejected document's key, text and length decide, so rows that repeat them share the decision.
    """
    model = langid.fit(docs.where(~langid.split(F.col("doc_id"))))
    return langid.accepted(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space."""
    return dedup.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return minhash.deduplicate(docs, size=5, threshold=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them, the last one of a source cut at its budget."""
    return mixing.mixture(docs).withColumn("n_chars", F.length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests per row."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digest=True)


STAGES = [("language_id", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix_sources", mix),
          ("byte_bpe", encode)]

#: byte-pair encoding and the language model have no SQL form; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
