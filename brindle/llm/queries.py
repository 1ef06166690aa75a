"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language, merkle, mixing, oracles, packing, quality, ranked, secrets, simhash, substrings, topk, urls, warc
from .runtime import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed columns; then the bytes that stay, and whether any had to go."""
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return out.withColumn("n_kept", F.col("n_bytes") - F.col("n_removed")).withColumn("has_repeats", F.col("n_removed") > 0)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact phrase matches, and in n_near and near_items the items that only proximity finds."""
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_pages(table(spark, sf_dir, "pages"), urls.default_rules(spark))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.report(table(spark, sf_dir, "embeddings"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_substring_dedup, op2_quality_rules, op3_warc_revisits, op4_decontamination, op5_url_filters, op6_language_id, op7_secret_scans, op8_simhash, op9_packing, op10_mixing, op11_topk, op12_merkle, op13_ranked_search)
}

ORACLES: dict[str, str] = oracles.ORACLES
