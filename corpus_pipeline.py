"""From a table of documents to token counts: recognise, deduplicate, mix, tokenize.

Every stage takes what the one before kept, as Parquet read anew, and works on all of it. All but
the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluiceway.llm import bpe, exact_dedup, language, mixing, ngram_join
from sluiceway.llm.common import settle


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable text go."""
    return language.recognised(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest id stays."""
    return exact_dedup.survivors(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest id stays."""
    return ngram_join.representatives(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; sources weigh 5, 2, 1 and share 150% of all words."""
    return mixing.repeated(docs, mixing.five_two_one, share=1.5, most=2.0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document of the mix and the digests of their ids and decoded bytes."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.tokenized(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("language", known_language),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard", near_copies),
    ("pareto_mix", mixed_sources),
    ("byte_bpe", tokens),
]

# Sampling by hash and merges by rank can't be said in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
