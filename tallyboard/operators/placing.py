"""Places, ties, points and prize money of the rounds of an event.

Everything here depends on a round only through its event, division and adjusted score, so
it is worked out once per distinct score and joined to the rounds afterwards.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.operators.ranking import value_ranks
from tallyboard.schemas import POINTS

FIELD = ["league_id", "division", "event_id"]
SCORE = [*FIELD, "adjusted_score"]


def with_adjusted_score(raw_scores: DataFrame, handicaps: DataFrame) -> DataFrame:
    """Rounds with their handicap and the score after it; without a handicap the raw score counts."""
    adjusted = F.coalesce(F.col("raw_score") - F.col("handicap"), F.col("raw_score"))
    return (
        raw_scores.select("raw_score_id", *FIELD, "player_name", "player_username", "raw_score")
        .join(handicaps.select("raw_score_id", "handicap"), "raw_score_id", "left")
        .withColumn("adjusted_score", adjusted)
    )


def score_places(scored: DataFrame) -> DataFrame:
    """Place, ties and field size of each distinct adjusted score. The lowest score wins."""
    return value_ranks(scored, FIELD, "adjusted_score").withColumnRenamed("group_size", "num_players")


def with_pot_share(places: DataFrame, payouts: DataFrame) -> DataFrame:
    """Add the share of the pot each player on a score gets.

    Tied players split the shares of the places they cover; places beyond the ladder pay
    nothing. The ladder of a field size travels as one small array, so the match on field
    size is an ordinary equi join that adds no rows.
    """
    ladder = payouts.groupBy("n_players").agg(
        F.collect_list(F.struct("position", "percentage")).alias("ladder")
    )
    covered = F.filter(
        "ladder",
        lambda rung: rung["position"].between(F.col("place"), F.col("place") + F.col("tie_count") - 1),
    )
    pooled = F.aggregate(
        covered,
        F.lit(0).cast("decimal(20,9)"),
        lambda total, rung: (total + F.coalesce(rung["percentage"], F.lit(0))).cast("decimal(20,9)"),
    )
    share = F.coalesce(pooled, F.lit(0).cast("decimal(20,9)")) / F.col("tie_count").cast("decimal(20,0)")
    return (
        places.join(ladder, places["num_players"] == ladder["n_players"], "left")
        .withColumn("split_percentage", F.round(share, 9).cast("decimal(10,9)"))
        .drop("n_players", "ladder")
    )


def points() -> Column:
    """Players beaten plus one, times the event's multiplier; none if the event does not count."""
    beaten = (F.col("num_players") - F.col("place") + 1).cast("decimal(12,0)")
    earned = beaten * F.coalesce(F.col("points_multiplier"), F.lit(1).cast("decimal(6,3)"))
    return F.when(F.col("is_excluded_from_points") == F.lit(True), F.lit(0)).otherwise(earned).cast(POINTS)


def payout(from_year: int) -> Column:
    """Prize money in whole units: the buy-ins less the cash share, times the pot share."""
    buy_in = F.coalesce("buy_in_override_ammt", "league_entry_fee").cast("decimal(10,2)")
    kept = (F.lit(1) - F.col("league_cash_percentage") / 100).cast("decimal(6,4)")
    pot = F.col("num_players").cast("decimal(9,0)") * buy_in * kept
    won = F.round(F.round(pot * F.col("split_percentage"), 9), 0)
    return F.when(F.year("event_end_date") >= from_year, won).otherwise(F.lit(0)).cast("decimal(18,0)")
