"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import byte_bpe, mixing, near_dedup, quality
from clickweave.llm import exact_dedup as exact
from clickweave.llm.common import prepare, table, written
from clickweave.llm.queries import split_pattern, tokenizer_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (labels: the table beside the documents)."""
    return quality.accepted(prepare(spark) and docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (the smallest id); rows with a null id stay."""
    gone = near_dedup.near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    gone = written(gone, "near-removed")
    return docs.join(F.broadcast(gone) if gone.count() <= near_dedup.BROADCAST_IDS else gone, "doc_id", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as rows: every document once per epoch, so that the sources' shares
    are their target weights, in files ordered by place in the mix."""
    return mixing.mix_rows(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids`` (ids: little-endian unsigned 32-bit integers)."""
    docs = docs.select("doc_id", "lang", "source", "text")
    coded = byte_bpe.encode_documents(prepare(spark) and docs, tokenizer_path("byte_bpe_multi_50k.tiktoken"), split_pattern())
    return coded.select("doc_id", "lang", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids")
