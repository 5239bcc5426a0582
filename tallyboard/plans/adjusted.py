"""Every round with its place, points, prize money and season standing so far."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.operators.matching import join_groups
from tallyboard.operators.placing import (
    SCORE,
    payout,
    points,
    score_places,
    with_adjusted_score,
    with_pot_share,
)
from tallyboard.operators.ranking import running_totals
from tallyboard.sources.tables import staged


def adjusted_scores(
    raw_scores: DataFrame,
    handicaps: DataFrame,
    payouts: DataFrame,
    events: DataFrame,
    leagues: DataFrame,
    payout_from_year: int = 2016,
) -> DataFrame:
    """Rounds meet their handicaps once, in the table written here.

    Results are written too, one row per distinct score of a field: their size is then known before the rounds
    are touched, so where they are small the rounds get them without a shuffle. Like rows stand together, by score
    at first and by day in the end, as that makes shuffles and files smaller.
    """
    scored = staged(with_adjusted_score(raw_scores, handicaps).sortWithinPartitions(*SCORE), "scored_rounds")
    event_terms = events.select(
        "event_id", "event_end_date", "is_excluded_from_points", "points_multiplier", "buy_in_override_ammt"
    )
    league_terms = leagues.select("league_id", "league_name", "league_entry_fee", "league_cash_percentage")
    results = (
        with_pot_share(score_places(scored), payouts)
        .join(event_terms, "event_id")
        .join(league_terms, "league_id")
        .select(
            *SCORE,
            "league_name",
            "event_end_date",
            "place",
            points().alias("points"),
            payout(payout_from_year).alias("payout"),
        )
    )
    rounds = join_groups(scored, staged(results, "score_results"), SCORE)
    player, day, total = ["league_id", "division", "player_username"], "event_end_date", "season_points_as_of_event"
    totals = running_totals(rounds, player, day, "points", total, by_year=True)
    return join_groups(rounds, totals, ["league_id", "division", day, "player_username"]).select(
        "raw_score_id",
        "event_id",
        "league_id",
        "league_name",
        "event_end_date",
        F.year("event_end_date").alias("year"),
        "division",
        "player_name",
        "player_username",
        "raw_score",
        "handicap",
        "adjusted_score",
        "place",
        "points",
        "payout",
        "season_points_as_of_event",
    )
