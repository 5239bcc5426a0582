"""Handicaps from a player's most recent rounds.

All rounds a player has in a league on one day see the same earlier rounds, so the history
is worked out on one row per player and day. The rounds of a day are first dealt into shares
and reduced to one row per share. So no group holds more than days times shares rows, even
for a name that most rounds share, and even if they were all played on one day.
"""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PLAYER = ["league_id", "player_username"]
PLAYER_DAY = [*PLAYER, "event_end_date"]
RULES = [
    "handicap_minimum_rounds",
    "handicap_rounds_considered",
    "handicap_base_score",
    "handicap_multiplier",
]
SLOT = 2**32
# Rounds of one day are ordered by id. A share is a range of ids, those with the same first
# characters, so the shares of a day follow each other as the ids do and no result depends on
# how many there are. Ids are hashes in hexadecimal: two characters make 256 even shares.
SHARE_CHARACTERS = 2


def share_of(round_id: str, characters: int | None = None) -> Column:
    return F.substring(round_id, 1, SHARE_CHARACTERS if characters is None else characters)


def league_rounds(raw_scores: DataFrame, events: DataFrame, leagues: DataFrame, as_of: date) -> DataFrame:
    """Rounds of handicap leagues inside the league's lookback, with what each round is used for.

    `counts` rounds feed later handicaps, `receives` rounds get one. A flag that is NULL
    is neither true nor false, so such a round does neither.
    """
    rules = leagues.where(F.col("league_is_handicap") == F.lit(True)).select(
        "league_id", "handicap_years_lookback", *RULES
    )
    days = events.select(
        "event_id",
        "event_end_date",
        F.coalesce(F.col("is_excluded_from_handicap") == F.lit(False), F.lit(False)).alias("counts"),
        F.coalesce(F.col("is_no_handicap_applied") == F.lit(False), F.lit(False)).alias("receives"),
    )
    first_year = F.lit(as_of.year) - F.col("handicap_years_lookback")
    return (
        raw_scores.select("raw_score_id", "event_id", "league_id", "player_username", "raw_score")
        .join(days.where("counts or receives"), "event_id")
        .join(rules, "league_id")
        .where(F.year("event_end_date") >= first_year)
        .select("raw_score_id", "raw_score", *PLAYER_DAY, share_of("raw_score_id").alias("share"), *RULES, "counts", "receives")
    )


def player_days(rounds: DataFrame) -> DataFrame:
    """One row per player and day with the day's history.

    earlier_rounds    counting rounds on earlier days
    considered        the latest counting rounds up to and including the day, newest first,
                      as many as the league considers
    receiving_rounds  rounds of the day that get a handicap
    shares            how many of them each share of the day has
    """
    in_share = W.partitionBy(*PLAYER_DAY, "share").orderBy(F.desc("counts"), F.desc("raw_score_id"))
    considered = F.col("handicap_rounds_considered")
    wanted = F.col("counts") & (F.col("newest") <= considered)
    round_taken = F.struct("raw_score_id", "raw_score", "event_end_date")
    shares = (
        rounds.where(F.col("player_username").isNotNull() & (considered > 0))
        .withColumn("newest", F.row_number().over(in_share))
        .groupBy(*PLAYER_DAY, "share", *RULES)
        .agg(
            F.count_if("counts").alias("counting"),
            F.count_if("receives").alias("receiving"),
            F.min(F.when(F.col("receives"), F.col("raw_score_id"))).alias("first_id"),
            F.collect_list(F.when(wanted, round_taken)).alias("latest"),
        )
    )
    receivers = F.struct("share", "receiving")
    # Partitioned by player here, so that neither the day totals nor the windows shuffle again.
    days = (
        shares.repartition(*PLAYER)
        .groupBy(*PLAYER_DAY, *RULES)
        .agg(
            F.sum("counting").alias("counting_rounds"),
            F.sum("receiving").alias("receiving_rounds"),
            F.min("first_id").alias("first_receiver"),
            F.sort_array(F.flatten(F.collect_list("latest")), asc=False).alias("latest"),
            F.collect_list(F.when(F.col("receiving") > 0, receivers)).alias("shares"),
        )
        .withColumn("latest", F.slice("latest", F.lit(1), considered.cast("int")))
    )

    in_order = W.partitionBy(*PLAYER).orderBy("event_end_date")
    before = in_order.rowsBetween(W.unboundedPreceding, -1)
    so_far = in_order.rowsBetween(W.unboundedPreceding, 0)
    # Rounds are set SLOT / considered apart, so a range just short of SLOT always spans the
    # days of exactly the last `considered` rounds, whatever that number is in the league.
    spaced = W.partitionBy(*PLAYER).orderBy("slot").rangeBetween(-(SLOT - 1), 0)
    last_days = F.reverse(F.collect_list("latest").over(spaced))
    return (
        days.withColumn("taken", F.sum(F.size("latest")).over(so_far))
        .withColumn("earlier_rounds", F.coalesce(F.sum("counting_rounds").over(before), F.lit(0)))
        .withColumn("slot", F.expr(f"taken * {SLOT} div handicap_rounds_considered"))
        .withColumn(
            "considered",
            F.slice(F.flatten(last_days), F.lit(1), F.col("handicap_rounds_considered").cast("int")),
        )
        .drop("slot", "latest")
    )


def _average(scores: Column) -> Column:
    total = F.aggregate(scores, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return F.when(F.size(scores) > 0, total / F.size(scores))


def with_next_handicap(days: DataFrame) -> DataFrame:
    """Add the handicap the day leads to, and the scores it was made of."""
    scores = F.filter(F.transform("considered", lambda r: r["raw_score"]), lambda s: s.isNotNull())
    over_par = (_average(F.col("scores")) - F.col("handicap_base_score")) * F.col("handicap_multiplier").cast("double")
    strokes = F.round(over_par, 0).cast("bigint")
    too_few = F.col("handicap_minimum_rounds") - 1 > F.col("earlier_rounds")
    return days.withColumn("scores", scores).select(
        *days.columns,
        F.when(too_few, F.lit(0).cast("bigint"))
        .when(strokes.isNotNull(), F.greatest(strokes, F.lit(0).cast("bigint")))
        .alias("next_handicap"),
        F.when(F.size("scores") > 0, F.array_join(F.transform("scores", lambda s: s.cast("string")), ","))
        .alias("next_raw_scores_considered"),
    )


def receiving_rounds(rounds: DataFrame, history: DataFrame, keys: list[str] = PLAYER_DAY) -> DataFrame:
    """The rounds that get a handicap, next to the history of their day or share of a day."""
    return (
        rounds.where("receives")
        .select("raw_score_id", "raw_score", *PLAYER_DAY, *[key for key in keys if key not in PLAYER_DAY])
        .join(history, keys)
    )


def considered_rounds(rounds: DataFrame) -> DataFrame:
    """Every receiving round with each of the rounds its next handicap is made of."""
    return (
        receiving_rounds(rounds, player_days(rounds))
        .select("raw_score_id", *PLAYER_DAY, F.posexplode("considered").alias("recency", "used"))
        .select(
            "raw_score_id",
            *PLAYER_DAY,
            (F.col("recency") + 1).cast("bigint").alias("recency"),
            F.col("used.raw_score").alias("used_raw_score"),
            F.col("used.event_end_date").alias("used_date"),
        )
    )


def latest_per_player(handicaps: DataFrame) -> DataFrame:
    """Each player's newest handicap row in a league."""
    return handicaps.where(F.col("handicap_rank") == 1)
