"""Corpus pipeline: judge quality, drop near copies, mask secrets, pack.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; every stage
but the last returns the columns of ``documents``. ``run`` writes each stage's rows as Parquet
below the shared folder and reads them again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from periodstats.llm import ngram_join, packing, quality_rules, secret_scan
from periodstats.llm.common import materialise, table

#: The learned decision list and the join have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list."""
    return quality_rules.keep_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.keep_one_per_class(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches over all that is left."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("ngram_join", near_duplicates),
          ("secret_scan", mask_secrets), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs
