"""The handicap of every round."""

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyboard.operators.handicap import (
    PLAYER,
    PLAYER_DAY,
    league_rounds,
    player_days,
    receiving_rounds,
    with_next_handicap,
)


def handicaps(
    raw_scores: DataFrame, events: DataFrame, leagues: DataFrame, as_of: date, run_time: datetime
) -> DataFrame:
    """One row per round that gets a handicap and has at least one counting round behind it.

    A round plays with the handicap of the player's previous such round. The newest round of a
    player has handicap_rank 1. Days pass their results back to the shares of their rounds, so
    a crowded day is numbered by many tasks.
    """
    rounds = league_rounds(raw_scores, events, leagues, as_of)
    listed = (F.col("taken") > 0) & (F.col("receiving_rounds") > 0)
    in_order = W.partitionBy(*PLAYER).orderBy("event_end_date")
    before = in_order.rowsBetween(W.unboundedPreceding, -1)
    so_far = in_order.rowsBetween(W.unboundedPreceding, 0)
    everything = W.partitionBy(*PLAYER)
    listed_rounds = F.when(listed, F.col("receiving_rounds")).otherwise(0)
    carried = {
        name: F.last(F.when(listed, F.col(name)), ignorenulls=True).over(before).alias(f"previous_{name}")
        for name in ("next_handicap", "next_raw_scores_considered")
    }
    days = (
        with_next_handicap(player_days(rounds))
        .select(
            *PLAYER_DAY,
            "first_receiver",
            "shares",
            "next_handicap",
            "next_raw_scores_considered",
            *carried.values(),
            (F.sum(listed_rounds).over(everything) - F.sum(listed_rounds).over(so_far)).alias("newer_rounds"),
            listed.alias("listed"),
        )
        .where("listed")
    )
    newer_in_day = F.aggregate(
        F.filter("shares", lambda other: other["share"] > F.col("part.share")),
        F.lit(0).cast("bigint"),
        lambda total, other: total + other["receiving"],
    )
    day_shares = days.withColumn("part", F.explode("shares")).select(
        "*", F.col("part.share").alias("share"), (F.col("newer_rounds") + newer_in_day).alias("newer")
    ).drop("part", "shares", "newer_rounds", "listed")

    share = [*PLAYER_DAY, "share"]
    newest_first = W.partitionBy(*share).orderBy(F.desc("raw_score_id"))
    first_of_day = F.col("raw_score_id") == F.col("first_receiver")

    def played_with(name):
        return F.when(first_of_day, F.col(f"previous_{name}")).otherwise(
            F.coalesce(name, f"previous_{name}")
        )

    return receiving_rounds(rounds, day_shares, share).select(
        "raw_score_id",
        "raw_score",
        "next_handicap",
        "next_raw_scores_considered",
        *PLAYER_DAY,
        played_with("next_handicap").alias("handicap"),
        played_with("next_raw_scores_considered").alias("raw_scores_considered"),
        (F.col("newer") + F.row_number().over(newest_first)).alias("handicap_rank"),
        F.lit(run_time).cast("timestamp").alias("create_time"),
    )
