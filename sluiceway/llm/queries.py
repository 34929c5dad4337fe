"""The registered queries over the given tables, one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import (
    bpe,
    decision_list,
    exact_dedup,
    hard_negatives,
    language,
    licenses,
    mixing,
    ngram_join,
    periodic_runs,
    pii,
    simhash_tree,
    substring_dedup,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of a session and a folder under its name, with SQL of equal result."""

    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query(
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
      doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """
)
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.decide(table(spark, folder, "documents"))


@query()
def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.tokenized(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query()
def op1_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), mixing.five_two_one, share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query()
def op5_decision_list(spark: SparkSession, folder: str) -> DataFrame:
    return decision_list.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents")).drop("detections")


@query()
def op9_string_kernel_language(spark: SparkSession, folder: str) -> DataFrame:
    found = language.identify(table(spark, folder, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query(
    """
    WITH p AS (
      SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        sha1(coalesce(html, '')) AS payload_digest, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS newest
      FROM pages
    )
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= 1000 AND page_id <> newest THEN newest END AS refers_to
    FROM p
    """
)
def op6_warc_normaliser(spark: SparkSession, folder: str) -> DataFrame:
    read = warc.archive_and_read(table(spark, folder, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


@query()
def op7_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents"))


@query()
def op10_prefix_doubling(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents"))


@query(
    """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
        CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
    ), positives AS (
      SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score
      FROM scored WHERE label = own
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, p.positive_id,
      CAST(row_number() OVER same AS INTEGER) AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.own
      AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
    WINDOW same AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
    QUALIFY row_number() OVER same <= 3
    """
)
def op11_hilbert_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings"), label, F.col("vec_id") % 50 == 0)


@query()
def op12_simhash_tree(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_tree.near_duplicates(table(spark, folder, "documents"))


@query()
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.summarised(table(spark, folder, "documents"), periodic_runs.tail_repeated)


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
