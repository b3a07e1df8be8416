"""The registered queries of this subpackage: each operator over its whole table, with production settings."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.llm import (
    ann,
    bpe,
    collocations,
    conversation_repair,
    mixing,
    ngram_join,
    personal_data,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    token_count,
    toxicity,
)
from tidelane.llm.oracle import oracle_sql as oracle_sql

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe_encoding(spark: SparkSession, folder: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text, per document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    tokens = bpe.bpe_round_trip(docs, public_tokenizers.path(BYTE_BPE))
    return tokens.select(
        "doc_id",
        bpe.token_count("token_ids").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Number of unigram tokens of each document, by the pieces and scores of a vocabulary file."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_count.token_counts(docs, public_tokenizers.path(PIECES))


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and positions of secrets per document."""
    scanned = secret_scan.scan_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    return scanned.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of each fiftieth one."""
    is_query = F.col("vec_id") % 50 == 0
    return ann.nearest_neighbours(table(spark, folder, "embeddings"), is_query)


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near copies and number of links of each document."""
    return ngram_join.ngram_join(table(spark, folder, "documents").select("doc_id", "text"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, base verdict and adaptive verdict per document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade, chance of the accepted grade and verdict, per document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    graded = quality_classifier.classify_quality(docs, table(spark, folder, "labels"))
    return graded.select("doc_id", "expected_grade", "tail", "accepted")


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot per document; shards differ by one row at most."""
    placed = sharding.feistel_shards(table(spark, folder, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of each document, with the target of its source and the slots that take them."""
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out mark, score and prediction per document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return collocations.collocations(table(spark, folder, "documents").select("lang", "text"))


def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and positions of personal data per document."""
    found = personal_data.personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    digest = F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", digest, "spans")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with the damage that their number decides; ``present`` is false for those that it drops."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20
    return turns.select(
        "conv_id",
        "turn",
        F.when(hit == 4, "user").otherwise(said("role")).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text")).alias("text"),
        (hit != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(1), F.when(hit == 3, 2).otherwise(1))).alias("copy"),
    )


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest audit and digest of the repaired text of each damaged conversation."""
    return conversation_repair.audit_conversations(damaged(table(spark, folder, "conversations")), F.col("present"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe_encoding": op1_bpe_encoding,
        "op2_token_counts": op2_token_counts,
        "op3_secret_scan": op3_secret_scan,
        "op4_nearest_neighbours": op4_nearest_neighbours,
        "op5_ngram_join": op5_ngram_join,
        "op6_quality_rules": op6_quality_rules,
        "op7_quality_classifier": op7_quality_classifier,
        "op8_sharding": op8_sharding,
        "op9_mixing": op9_mixing,
        "op10_toxicity": op10_toxicity,
        "op11_phrase_collocations": op11_phrase_collocations,
        "op12_personal_data": op12_personal_data,
        "op13_conversation_repair": op13_conversation_repair,
    }
