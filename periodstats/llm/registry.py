"""Registered queries of the subpackage: whole tables, production parameters, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodstats.llm import (ann_scan, bpe_chunks, chat_format, collocations, html_extract, lm_mixing,
                             ngram_join, packing, quality_rules, repeats, secret_scan, spelling, url_reputation)
from periodstats.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_format.with_control_case(table(spark, sf_dir, "conversations"))
    return chat_format.digests(chat_format.format_conversations(rows))


def op3_ann_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_scan.search(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op5_lm_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_mixing.score_documents(table(spark, sf_dir, "documents"))


def op6_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality label of the document with the page's number."""
    outcomes = table(spark, sf_dir, "labels").filter("quality is not null").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    return url_reputation.judge_urls(table(spark, sf_dir, "pages"), outcomes,
                                     url_reputation.RULES)


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"),
                                         table(spark, sf_dir, "labels"))


def op9_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_chunks.digests(table(spark, sf_dir, "documents"),
                              public_tokenizers.path("word_bpe_49k.json"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_join(table(spark, sf_dir, "documents"))


def op11_rlz_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents")).drop("n_factors")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = [f for name, f in globals().items() if name.startswith("op") and callable(f)]
    return {f.__name__: f for f in sorted(found, key=lambda f: int(f.__name__[2:].split("_")[0]))}


def oracle_sql() -> dict[str, str]:
    return {"op1_length_buckets": packing.oracle_sql(),
            "op2_chat_format": chat_format.oracle_sql(),
            "op6_url_reputation": url_reputation.oracle_sql(),
            "op11_rlz_repeats": repeats.oracle_sql(),
            "op12_spelling_variants": spelling.oracle_sql(),
            "op13_collocations": collocations.oracle_sql()}
