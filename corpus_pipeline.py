"""From raw documents to packed training sequences: five stages over the operators of sedimenta.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import exact_dedup, near_dup, packing, quality, toxicity
from sedimenta.session import bounded_batches, ensure_checkpoint_dir, remove, scratch


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


# All stages take rows as they come: null and empty texts are scored (as empty) and are equal to each other only exactly,
# never nearly; a repeated row meets the same fate as its twin, of equal texts with equal smallest ids both stay; rows
# that share an id but not a text are told apart by their text; a row without an id goes only if a row with an id has
# the same text; an empty table gives an empty one; columns besides doc_id and text are passed on, whatever their names.


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are rather good than bad."""
    bounded_batches(spark)
    return quality.keep_good(docs, quality.train_model(docs, _labels(spark, sf_dir)), threshold=0.5)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are not surely toxic."""
    bounded_batches(spark)
    return toxicity.drop_toxic(docs, toxicity.train_model(docs, _labels(spark, sf_dir)), threshold=0.7)


_KEY = ["_id_key", "_text_key"]


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) and two hashes that tell rows apart."""
    return docs.select("doc_id", "text", *(k.alias(n) for k, n in zip(_keys(), _KEY, strict=True)))


def _keys() -> list[Column]:
    return [F.xxhash64("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))]


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of equal texts, the document with the smallest doc_id. Only keys and documents that go are shuffled."""
    found = exact_dedup.exact_duplicates(_keyed(docs), carry=_KEY)
    return exact_dedup.without(docs, found.filter("not kept").select(_KEY), *_keys())


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of documents that shingles of five words link, the one with the smallest doc_id; documents without an id stay."""
    bounded_batches(spark)
    found = near_dup.near_duplicates(_keyed(docs), width=5, percent=80, carry=_KEY)
    return exact_dedup.without(docs, found.filter("not kept and doc_id is not null").select(_KEY), *_keys())


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of at most 4096 tokens."""
    bounded_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("exact dedup", exact_deduplication),
    ("minhash near-dedup", near_deduplication),
    ("best-fit packing", best_fit_packing),
]

#: Classifiers are trained here and tokens come from a tokenizer; SQL can't say either. tests/llm/test_pipeline.py holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage keeps is written to the shared folder and read again by the next one.

    Folders and checkpoints of a stage are removed when the next one has its own; those of the result stay, it is read from them.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
    return docs
