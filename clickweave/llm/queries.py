"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import (
    byte_bpe, context_mixing, conversation_repair, cross_polytope, exact_dedup, hard_negatives, licenses, mixing, near_dedup, quality,
    secrets, substring_dedup, token_shards,
)
from clickweave.llm.common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.scores(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(table(spark, sf_dir, "documents"))


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_shards.write_shards(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return token_shards.read_shards(manifest)


def op5_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), split_pattern())


def op8_empirical_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts are the sources, paths the languages within a source."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source / language / id."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    return licenses.scan(table(spark, sf_dir, "documents"), F.concat_ws("/", part("source"), part("lang"), part("doc_id")))


def op11_ida_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damage(conversations), conversations)


def op12_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op13_secret_lexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cross_polytope": op1_cross_polytope,
    "op2_context_mixing": op2_context_mixing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_token_shards": op4_token_shards,
    "op5_pfair_mix": op5_pfair_mix,
    "op6_window_dedup": op6_window_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_empirical_bayes": op8_empirical_bayes,
    "op9_chosen_path": op9_chosen_path,
    "op10_license_scan": op10_license_scan,
    "op11_ida_repair": op11_ida_repair,
    "op12_angular_negatives": op12_angular_negatives,
    "op13_secret_lexing": op13_secret_lexing,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": exact_dedup.ORACLE_SQL,
    "op5_pfair_mix": mixing.ORACLE_SQL,
    "op6_window_dedup": substring_dedup.ORACLE_SQL,
    "op9_chosen_path": near_dedup.ORACLE_SQL,
    "op11_ida_repair": conversation_repair.ORACLE_SQL,
    "op12_angular_negatives": hard_negatives.ORACLE_SQL,
}
