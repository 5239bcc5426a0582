"""Reports on one season: events, players, the season log and hole scores.

Adjusted scores are stored by year, so each report reads the season's files only.
"""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyboard.operators.handicap import latest_per_player
from tallyboard.operators.ranking import with_rank
from tallyboard.session import shuffle_width


def in_season(day: str, season: int) -> Column:
    """A date of the season, as a range so that it reaches the file scan."""
    return F.col(day).between(F.lit(date(season, 1, 1)), F.lit(date(season, 12, 31)))


def season_event_summary(events: DataFrame, adjusted: DataFrame, leagues: DataFrame, season: int) -> DataFrame:
    """Events of the season with their turnout, newest ranked first in each league."""
    turnout = (
        adjusted.where(F.col("year") == season)
        .groupBy("event_id")
        .agg(
            F.count("*").alias("num_players"),
            F.round(F.avg("raw_score"), 2).alias("average_raw_score"),
        )
    )
    listed = (
        events.where(in_season("event_end_date", season))
        .select("event_id", "league_id", "event_name", "event_end_date")
        .join(turnout, "event_id")
        .join(leagues.select("league_id", "league_name"), "league_id")
        .withColumn("year", F.year("event_end_date"))
    )
    return with_rank(listed, ["year", "league_id"], "event_end_date", "event_rank_in_league", descending=True).select(
        "event_id",
        "league_id",
        "league_name",
        "event_name",
        "event_end_date",
        "year",
        "num_players",
        "average_raw_score",
        "event_rank_in_league",
    )


def season_players_summary(adjusted: DataFrame, handicaps: DataFrame, season: int) -> DataFrame:
    """Season standing of each player per league, division and name."""
    current = latest_per_player(handicaps).select(
        "league_id",
        "player_username",
        "next_handicap",
        F.col("next_raw_scores_considered").alias("next_handicap_scores"),
    )
    totals = (
        adjusted.where(F.col("year") == season)
        .groupBy("player_username", "player_name", "league_id", "league_name", "division")
        .agg(
            F.max("event_end_date").alias("last_played_date"),
            F.round(F.avg("raw_score"), 2).alias("average_raw_score"),
            F.count("*").alias("events_played"),
            F.sum("points").alias("season_points"),
            F.sum("payout").alias("season_winnings"),
        )
        .join(current, ["league_id", "player_username"], "left")
    )
    return with_rank(totals, ["league_id", "division"], "season_points", "season_place", descending=True).select(
        "player_username",
        "player_name",
        "league_id",
        "league_name",
        "division",
        "last_played_date",
        "average_raw_score",
        "events_played",
        "season_points",
        "season_place",
        "season_winnings",
        "next_handicap",
        "next_handicap_scores",
    )


PLAYERS_PER_SHARE = 2000


def league_shares(players: DataFrame, most: int) -> DataFrame:
    """(league_id, shares): into how many shares the players of a league are dealt, by their number."""
    count = F.ceil(F.count("*") / PLAYERS_PER_SHARE).cast("int")
    return players.groupBy("league_id").agg(F.least(count, F.lit(most)).alias("shares"))


def season_log(
    players: DataFrame, season_events: DataFrame, leagues: DataFrame, adjusted: DataFrame, season: int
) -> DataFrame:
    """Every player of the season at every event of their league, played or missed.

    Division and season points are carried forward over missed events; a round without its own
    takes what is known up to its event, of several rounds there the last by id. Standings of
    one league meet all its events, so the players of a large league are dealt into shares and the
    much shorter event list is repeated for each share: a league with a large part of the
    players does not end up in one task, and a small one has its events once. The carrying runs on one row per player and event;
    rounds are reduced to that before the shuffle and joined back afterwards, so a name that
    many rounds share makes no large group.
    """
    shares = league_shares(players, shuffle_width(players.sparkSession))
    standing = ["player_username", "player_name", "standing_division"]
    entrants = players.select(
        "player_username", "player_name", "league_id", F.col("division").alias("standing_division")
    )
    entrants = entrants.join(shares, "league_id").withColumn("share", F.pmod(F.xxhash64(*standing), F.col("shares")).cast("int"))
    entrants = entrants.drop("shares")
    calendar = (
        season_events.select("event_id", "league_id", "event_name", "event_end_date")
        .join(leagues.select("league_id", "league_name"), "league_id")
        .join(shares, "league_id")
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        .drop("shares")
    )
    played = adjusted.where((F.col("year") == season) & F.col("player_username").isNotNull())
    carried = ["division", "season_points_as_of_event"]

    def newest(name):
        return F.max_by(name, F.when(F.col(name).isNotNull(), F.col("raw_score_id"))).alias(f"event_{name}")

    per_event = played.groupBy("event_id", "player_username").agg(
        F.lit(True).alias("took_part"), *[newest(name) for name in carried]
    )
    until_event = (
        W.partitionBy(*standing, "league_id", "year")
        .orderBy("event_end_date", "event_id")
        .rowsBetween(W.unboundedPreceding, 0)
    )
    grid = (
        entrants.join(calendar, ["league_id", "share"])
        .withColumn("year", F.year("event_end_date"))
        .join(per_event, ["event_id", "player_username"], "left")
        .withColumns({f"known_{name}": F.last(f"event_{name}", ignorenulls=True).over(until_event) for name in carried})
    )
    own = ["raw_score", "handicap", "adjusted_score", "place", "points", "payout"]
    rounds = played.select("event_id", "player_username", *own, *carried)
    missing = [F.lit(None).cast(rounds.schema[name].dataType).alias(name) for name in [*own, *carried]]
    missed = grid.where(F.col("took_part").isNull()).select("*", *missing)
    # The many rounds of a name and event stand on the left, where skew joins split them.
    with_rounds = rounds.join(grid.where("took_part"), ["event_id", "player_username"])
    return missed.unionByName(with_rounds).select(
        "player_username",
        "player_name",
        "league_id",
        "league_name",
        "event_id",
        "event_name",
        "event_end_date",
        "year",
        F.coalesce("division", "known_division").alias("division"),
        "raw_score",
        F.coalesce("handicap", F.lit(0)).alias("handicap"),
        "adjusted_score",
        "place",
        "points",
        "payout",
        F.coalesce("season_points_as_of_event", "known_season_points_as_of_event", F.lit(0)).alias(
            "season_points_as_of_event"
        ),
    )


# A filter of ids: this many words of 64 marks, 4 MB of them at most.
MARK_WORDS = 2**19


def with_marks(rows: DataFrame, key: str) -> DataFrame:
    """Add the word and the bit that stand for the key in a filter."""
    slot = F.pmod(F.xxhash64(key), F.lit(MARK_WORDS * 64))
    return rows.withColumns({"_word": F.shiftright(slot, 6).cast("int"), "_bit": slot.bitwiseAND(63).cast("int")})


def likely_in(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is among the keys, and some more: with 5 million keys about one in seven of the others.

    For large tables of which a join keeps little: what cannot match goes before the shuffle. The more keys there
    are, the more rows stay; none that matches is lost.
    """
    marks = with_marks(keys, key).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_marks"))
    # A hint, as only the code knows how small this stays; shuffled, the filter would be pointless.
    marked = with_marks(rows, key).join(F.broadcast(marks), "_word")
    return marked.where(F.getbit("_marks", "_bit") == 1).select(*rows.columns)


def season_hole_scores(
    adjusted: DataFrame, season_events: DataFrame, leagues: DataFrame, hole_scores: DataFrame, season: int
) -> DataFrame:
    """Hole by hole scores of the season's rounds.

    Holes of other rounds are dropped before the join, also where hole scores are not kept by year.
    """
    calendar = season_events.where(F.col("year") == season).select("event_id", "event_name", "event_end_date", "year")
    played = adjusted.where(F.col("year") == season)
    rounds = (
        played.select("raw_score_id", "event_id", "league_id", "player_username", "player_name")
        .join(calendar, "event_id")
        .join(leagues.select("league_id", "league_name"), "league_id")
    )
    holes = hole_scores.select("raw_score_id", "hole_number", "hole_score")
    return likely_in(holes, played.select("raw_score_id"), "raw_score_id").join(rounds, "raw_score_id").select(
        "player_username",
        "player_name",
        F.concat("player_name", F.lit(" ("), "player_username", F.lit(")")).alias("player_display_name"),
        "league_id",
        "league_name",
        "hole_number",
        "hole_score",
        "event_name",
        "event_end_date",
        "year",
    )
