"""The registered queries of this package: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.llm import (
    bloom_lm,
    clusters,
    divergence,
    fingerprints,
    heavy_light,
    languages,
    mixing,
    near_duplicates,
    packing,
    quality,
    site_style,
    toxicity,
    url_filter,
)
from tallyboard.llm.common import given


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(given(spark, folder, "documents"))


def op2_languages(spark: SparkSession, folder: str) -> DataFrame:
    return languages.identify(given(spark, folder, "documents"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.draw(given(spark, folder, "documents"))


def op4_site_style(spark: SparkSession, folder: str) -> DataFrame:
    return site_style.extract(given(spark, folder, "pages"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(given(spark, folder, "documents"))


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(given(spark, folder, "documents"), size=4, percent=80)


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(given(spark, folder, "pages"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(given(spark, folder, "documents"), given(spark, folder, "labels"))


def op9_bloom_lm(spark: SparkSession, folder: str) -> DataFrame:
    documents = given(spark, folder, "documents")
    return bloom_lm.score(documents, documents.where(~bloom_lm.held_out(F.col("doc_id"))))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.severity(given(spark, folder, "documents"), given(spark, folder, "labels"))


def op11_heavy_light(spark: SparkSession, folder: str) -> DataFrame:
    return heavy_light.linked(given(spark, folder, "documents"), size=4, percent=85)


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(given(spark, folder, "documents"))


def op13_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.cluster(given(spark, folder, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: made for name, made in globals().items() if name.startswith("op")}
