"""The training-corpus pipeline over ``documents``: quality, near copies, secrets, mixture, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and read again as the next one's
``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.functions.lineage import shared_path
from tidelane.llm import bpe, mixing, ngram_join, quality_classifier, secret_scan


def graded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.classify_quality(docs, labels).filter("accepted").select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.near_copies_removed(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts replaced by a mark and the number of characters made anew."""
    clean = secret_scan.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, packed as little-endian unsigned 32-bit integers, with the digests of
    the ids and of the decoded text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens = bpe.bpe_round_trip(docs.select("doc_id", "source", "text"), path)
    return tokens.select(
        "doc_id",
        "source",
        bpe.token_count("token_ids").alias("n_tokens"),
        "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_classifier", graded),
    ("ngram_jaccard_join", distinct),
    ("secret_scans", without_secrets),
    ("mixing", mixed),
    ("bpe", encoded),
]

#: SQL cannot express the learned classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each result is stored in the shared folder, so a lost executor costs
    a part of one stage only."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
