"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fathomline.llm import imatch, jaccard, media, mixing, packing, pii, suffix, tokencount, toxicity, warczip
from fathomline.llm.common import table


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.query(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.query(table(spark, sf_dir, "documents"))


def op3_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.query(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.query(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.query(table(spark, sf_dir, "documents"))


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.query(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.query(table(spark, sf_dir, "documents"))


def op10_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warczip.query(table(spark, sf_dir, "pages"))


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    op1_pii_surrogates, op2_token_counts, op3_imatch_fingerprints, op4_packing, op5_suffix_dedup, op6_media_columns, op7_source_mixing, op8_toxicity, op9_ngram_jaccard, op10_warc_packages,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op7_source_mixing": mixing.SQL, "op10_warc_packages": warczip.SQL}
