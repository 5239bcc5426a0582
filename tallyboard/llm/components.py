"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import stage

MOST_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    moved = down.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(u, v): every node of the links (u, v) but the least of its component, and that least one.

    Each round is written to the shared folder, so a lost executor costs one round at most. A node with
    very many neighbours is reduced before the shuffle and split by skew joins.
    """
    now = stage(links.where("u <> v").select("u", "v").distinct(), "links")
    before = None
    for _ in range(MOST_ROUNDS):
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("s")).first()
        if not state.n or state == before:
            return now
        before = state
        now = stage(_small_star(_large_star(now).distinct()).distinct(), "links")
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
