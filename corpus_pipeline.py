"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read back as the next
stage's docs. All stages but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyboard.llm import languages, mixing, near_duplicates, packing, quality
from tallyboard.llm.common import given, prepare, stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the n-gram filters recognise (operator 2)."""
    prepare(spark)
    return languages.keep_known(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio (operator 8)."""
    return quality.keep_good(docs, given(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, likeness of 0.8 (operator 6)."""
    prepare(spark)
    return near_duplicates.keep_first(docs, size=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics have their target weights (operator 3)."""
    prepare(spark)
    return mixing.keep_drawn(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in training windows (operator 5)."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("near_dedup", one_of_each),
    ("mixing", mixed),
    ("packing", packed),
]

# SQL can express neither the signatures nor the tokenizer nor the differencing; the tests compare
# the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
