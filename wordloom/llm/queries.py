"""The operators as queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm import (
    bagminhash,
    conversations,
    cotraining,
    distinct_words,
    divergence,
    language_model,
    packing,
    pieces,
    planes,
    repetition,
    sketches,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_plane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    read = planes.encoded_and_read_back(table(spark, sf_dir, "documents"), tokenizer, 2)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_scaled_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.compared_with_edits(table(spark, sf_dir, "documents"))


def op3_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return cotraining.with_scores(docs, labels).select(
        "doc_id", "quality_score", (F.col("quality_score") >= cotraining.KEEP_AT).alias("kept")
    )


def op5_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = distinct_words.encode_and_decode(
        table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN
    )
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_report(table(spark, sf_dir, "documents"))


def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_and_read_back(table(spark, sf_dir, "pages"))


def op8_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"))


def op9_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, 1).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


def op10_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_pattern_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_checkpointed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.audited(rows, copies="copies")


def op13_spanned_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode_and_decode(table(spark, sf_dir, "documents"), model)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).alias("source_bytes"),
    )


QUERIES: dict[str, Query] = {
    "op1_plane_files": op1_plane_files,
    "op2_scaled_sketches": op2_scaled_sketches,
    "op3_bagminhash": op3_bagminhash,
    "op4_cotraining": op4_cotraining,
    "op5_distinct_word_bpe": op5_distinct_word_bpe,
    "op6_repetition_coverage": op6_repetition_coverage,
    "op7_warc_index": op7_warc_index,
    "op8_backoff_automaton": op8_backoff_automaton,
    "op9_curve_packing": op9_curve_packing,
    "op10_ftrl_toxicity": op10_ftrl_toxicity,
    "op11_pattern_tree": op11_pattern_tree,
    "op12_checkpointed_repair": op12_checkpointed_repair,
    "op13_spanned_pieces": op13_spanned_pieces,
}
