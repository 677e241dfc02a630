"""The opN queries: each applies its operator to its whole table and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import bpe, exact_dedup, html_extract, license_scan, media, near_dup, packing, quality, samples, token_counts, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(exact_dedup.normalised(F.col("text")), 256))
    return exact_dedup.exact_duplicates(docs, carry=["text_sha256"])


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(_table(spark, sf_dir, "documents")).drop("detections")


def op5_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, sf_dir, "documents"))


def _scored(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select("doc_id", samples.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op6_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return _scored(quality.score(docs, quality.train_model(docs, _table(spark, sf_dir, "labels"))), 0.5)


def op7_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), width=2)


def op8_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return _scored(toxicity.score(docs, toxicity.train_model(docs, _table(spark, sf_dir, "labels"))), 0.7)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.context_limits(token_counts.length_histogram(_table(spark, sf_dir, "documents")))


_ALL = (op1_media_columns, op2_exact_dedup, op3_html_extraction, op4_license_scan, op5_bpe_chunk_reuse, op6_quality_crf, op7_minhash_near_dup, op8_toxicity_crf, op9_best_fit_packing, op10_token_counts)
QUERIES = {f.__name__: f for f in _ALL}

ORACLE_SQL = {
    "op2_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY norm)
    """,
}
