"""The registered queries of this package, by name, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import conversation_repair, decontaminate, embedding_dedup, language_id, license_scan, mixing, ngram_join, secret_scan, substring_dedup, \
    token_alignment, token_binary, token_counts, vp_tree
from ._common import table
from .oracle import ORACLE_SQL  # noqa: F401


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), key=F.col("doc_id"))
    return mixed.select("doc_id", "source", "mix_round", "mix_block", "mix_place", "mix_tokens")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op4_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_binary.token_binary(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op9_vp_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_tree.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.conversation_repair(table(spark, sf_dir, "conversations"))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.token_alignment(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                           tokenizer_path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_source_mixing, op3_ngram_jaccard_join, op4_token_binary, op5_license_scan,
    op6_benchmark_decontamination, op7_token_counts, op8_substring_dedup, op9_vp_tree_neighbours, op10_language_id,
    op11_conversation_repair, op12_embedding_dedup, op13_token_alignment)}
