"""Corpus pipeline: quality filter, exact and near deduplication, mixing, tokenization."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickweave.llm import stages
from clickweave.llm.common import table, written

STAGES = [
    ("quality_classifier", stages.quality_filter),
    ("exact_dedup", stages.exact_dedup),
    ("minhash_near_dedup", stages.near_dedup_stage),
    ("mix_sources", stages.mix),
    ("byte_bpe", stages.tokenize),
]

#: The classifier's logarithms and the BPE merges have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
