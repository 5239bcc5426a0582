"""The prize ladder: what share of the pot each paid place of a field gets."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.schemas import PAYOUTS

# Fixed values of the ladder.
LARGEST_FIELD = 100
PLAYERS_PER_PAID_PLACE = 3
DECAY = 0.64


def payout_ladder(spark: SparkSession, run_time: datetime, largest: int = LARGEST_FIELD) -> DataFrame:
    """One row per field size, up to the largest, and paid place; each place weighs 0.64 of the one above."""
    weights = F.transform(
        F.sequence(F.lit(0), (F.ceil(F.col("n_players") / PLAYERS_PER_PAID_PLACE) - 1).cast("int")),
        lambda step: F.pow(F.lit(DECAY), step),
    )
    total = F.aggregate("weights", F.lit(0.0), lambda a, b: a + b)
    share = F.col("weight") / F.col("total")
    return (
        spark.range(1, largest + 1)
        .withColumnRenamed("id", "n_players")
        .withColumn("weights", weights)
        .select("n_players", total.alias("total"), F.posexplode("weights").alias("step", "weight"))
        .select(
            "n_players",
            (F.col("step") + 1).cast("bigint").alias("position"),
            F.round("weight", 9).cast(PAYOUTS["weight"].dataType).alias("weight"),
            F.round(share, 9).cast(PAYOUTS["percentage"].dataType).alias("percentage"),
            F.round(share * 100, 4).cast(PAYOUTS["payout_percent"].dataType).alias("payout_percent"),
            F.lit(run_time).cast("timestamp").alias("create_time"),
        )
    )


def pot_share(place: Column, ties: Column, players: Column, largest: int | None = LARGEST_FIELD) -> Column:
    """The share of the pot that each of `ties` players on a place gets in a field of any size.

    The weights of the places they cover are a stretch of a geometric series, so no ladder is built: the sum is
    0.64^a - 0.64^b over 1 - 0.64^k, with k paid places. Fields above `largest` get nothing; None sets no limit.
    """
    paid = F.ceil(players / PLAYERS_PER_PAID_PLACE)
    power = lambda exponent: F.pow(F.lit(DECAY), F.least(exponent, paid))
    share = (power(place - 1) - power(place - 1 + ties)) / (1 - power(paid)) / ties
    counts = (players > 0) if largest is None else players.between(1, largest)
    return F.when(counts, F.round(share, 9)).otherwise(F.lit(0.0))


def field_ladders(fields: DataFrame, payouts: DataFrame) -> DataFrame:
    """The rungs for each field (`n_players`), every field once; one that the ladder does not know has NULL rungs."""
    return fields.select("n_players").distinct().join(payouts, "n_players", "left")
