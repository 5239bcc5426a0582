"""Mixing of sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic. The token weight of the cells is raked: for one
dimension after the other, every cell is multiplied by target / current sum of its value, `ROUNDS`
times over. A document is drawn with the probability scale * weight / tokens of its cell, 1 at most; the
draw compares it with a hash of doc_id, so a rerun draws the same. The scale makes the expected tokens
drawn a stated share of all tokens, `DRAWN`, or all that targets allow if that is less. So a small
cell with a high rate is taken whole and does not lower what is drawn of the others. Drawn tokens have the
target marginals in expectation, but for what cells taken whole fall short of.

The target share of a value is its share of tokens to the power `TEMPER`, unless shares are given;
then a value without a share is left out. A topic is the one of `TOPICS` with the most different
keywords in the text, the first of equals, or `other`.

Everything is DataFrame code. Only cells are raked: documents are reduced per cell before the shuffle,
and a window of the raking holds at most the cells of one value. Single sums go to the driver.

Defined cases: null values of a dimension are a value of their own. A text without words has no
tokens; a cell without tokens is not drawn from. Rows with equal doc_id are drawn alike, a null doc_id
like an empty text of it. Extra columns are ignored by `draw` and kept by `keep_drawn`. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.llm.common import prepare, stage
from tallyboard.llm.quality import words

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 8
TEMPER = 0.85
DRAWN = 0.5  # share of all tokens to draw
# Keywords of the topics, compared with whole lower-cased words.
TOPICS = {
    "legal": ("apache", "copyright", "gpl", "law", "legal", "license", "licensed", "mit", "rights", "terms", "warranty"),
    "technical": ("=", "api", "code", "data", "http", "key", "password", "secret", "server", "token", "version"),
    "contact": ("call", "contact", "email", "e-mail", "mail", "phone", "tel", "address"),
}
OTHER = "other"


def with_cells(documents: DataFrame, text: Column) -> DataFrame:
    """The table with the token count and topic of a text column added."""
    every = sorted({k for keys in TOPICS.values() for k in keys})
    counts = {t: F.size(F.array_intersect("met", F.array(*[F.lit(k) for k in keys]))) for t, keys in TOPICS.items()}
    most = F.greatest(*counts.values(), F.lit(1))
    topic = F.coalesce(*[F.when(n == most, F.lit(t)) for t, n in counts.items()], F.lit(OTHER))
    return (
        documents.withColumn("found", words(F.lower(text)))
        .withColumn("met", F.array_intersect("found", F.array(*[F.lit(k) for k in every])))
        .withColumn("n_tokens", F.size("found").cast("bigint"))
        .withColumn("topic", topic)
    )


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """The cells (dimensions, tokens) with their raked `weight`.

    `targets` may give tables (dimension, share); other dimensions are tempered.
    """
    table = cells
    for d in DIMENSIONS:
        own = Window.partitionBy(d)
        if targets and d in targets:
            given = targets[d].select(F.col(d).alias("value"), F.col("share").cast("double").alias(f"target_{d}"))
            table = table.join(given, F.col(d).eqNullSafe(F.col("value")), "left").drop("value")
            table = table.withColumn(f"target_{d}", F.coalesce(f"target_{d}", F.lit(0.0)))
        else:
            table = table.withColumn(f"target_{d}", F.pow(F.sum("tokens").over(own).cast("double"), F.lit(TEMPER)))
    table = table.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for d in DIMENSIONS:
            total = F.sum("weight").over(Window.partitionBy(d))
            scaled = F.when(total > 0, F.col("weight") * F.col(f"target_{d}") / total).otherwise(0.0)
            table = table.withColumn("weight", scaled)
    return table.select(*DIMENSIONS, "tokens", "weight")


def uniform(doc_id: Column) -> Column:
    """A number from 0 to below 1 by a hash of doc_id."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def scale_of(raked: DataFrame, drawn: float) -> float:
    """The number s with sum(least(tokens, s * weight)) = drawn * sum(tokens), or one that takes every cell whole.

    The sum is concave in s, so steps along its tangent come near from below and end as soon as no more
    cells are taken whole: a few sums over the cells.
    """
    total = raked.agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight")).first()
    if not total.weight:
        return 0.0
    budget, whole = drawn * total.tokens, 0
    scale = budget / total.weight
    while True:
        full = (F.col("weight") > 0) & (F.col("weight") * scale >= F.col("tokens"))
        at = raked.agg(
            F.count_if(full).alias("cells"),
            F.sum(F.when(full, F.col("tokens"))).alias("tokens"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        if at.cells <= whole or not at.weight:
            return scale
        whole, scale = at.cells, (budget - at.tokens) / at.weight


def probabilities(marked: DataFrame, targets: dict[str, DataFrame] | None, drawn: float = DRAWN) -> DataFrame:
    """(dimensions, probability) of every cell of the marked documents."""
    cells = marked.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    raked = stage(rake(cells, targets), "cells")
    rate = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    names = [F.col(d).alias(f"cell_{d}") for d in DIMENSIONS]
    return raked.select(*names, F.round(F.least(rate * scale_of(raked, drawn), F.lit(1.0)), 9).alias("probability"))


def in_cell() -> Column:
    first, *more = [F.col(d).eqNullSafe(F.col(f"cell_{d}")) for d in DIMENSIONS]
    for test in more:
        first = first & test
    return first


def draw(documents: DataFrame, targets: dict[str, DataFrame] | None = None, drawn: float = DRAWN) -> DataFrame:
    """One row per document: its cell, tokens, probability and whether it is drawn."""
    prepare(documents.sparkSession)
    plain = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "lang", "text")
    marked = with_cells(plain, F.col("text")).select("doc_id", *DIMENSIONS, "n_tokens")
    return marked.join(probabilities(marked, targets, drawn), in_cell()).select(
        "doc_id", *DIMENSIONS, "n_tokens", "probability", (uniform(F.col("doc_id")) < F.col("probability")).alias("drawn")
    )


def keep_drawn(documents: DataFrame, targets: dict[str, DataFrame] | None = None, drawn: float = DRAWN) -> DataFrame:
    """The documents, all columns as they are, that are drawn."""
    prepare(documents.sparkSession)
    row = F.col("row")
    whole = documents.select(F.struct("*").alias("row"))
    whole = whole.select("row", row["source"].alias("source"), row["lang"].alias("lang"))
    marked = with_cells(whole, row["text"]).select("row", *DIMENSIONS, "n_tokens")
    rated = marked.join(probabilities(marked.drop("row"), targets, drawn), in_cell())
    return rated.where(uniform(row["doc_id"]) < F.col("probability")).select("row.*")
