"""Column layouts of the stored tables.

Money, percentages and multipliers use narrow decimals: products of wide decimals lose
scale in Spark, and payouts have to be exact.
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
CASH_SHARE = T.DecimalType(5, 2)
MULTIPLIER = T.DecimalType(6, 3)
LADDER_SHARE = T.DecimalType(10, 9)
POINTS = T.DecimalType(18, 3)


def _struct(**columns):
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


STAMPS = {"create_time": T.TimestampType(), "update_time": T.TimestampType()}

LEAGUES = _struct(
    league_id=T.StringType(),
    league_name=T.StringType(),
    league_urls=T.StringType(),
    league_entry_fee=MONEY,
    league_cash_percentage=CASH_SHARE,
    league_is_handicap=T.BooleanType(),
    handicap_minimum_rounds=T.LongType(),
    handicap_rounds_considered=T.LongType(),
    handicap_years_lookback=T.LongType(),
    handicap_base_score=T.LongType(),
    handicap_multiplier=MULTIPLIER,
    **STAMPS,
)

EVENTS = _struct(
    event_id=T.StringType(),
    league_id=T.StringType(),
    event_name=T.StringType(),
    event_end_date=T.DateType(),
    export_url=T.StringType(),
    is_downloaded=T.BooleanType(),
    file_name=T.StringType(),
    file_path=T.StringType(),
    num_players=T.LongType(),
    download_date=T.TimestampType(),
    is_imported=T.BooleanType(),
    import_date=T.TimestampType(),
    is_excluded_from_handicap=T.BooleanType(),
    is_excluded_from_points=T.BooleanType(),
    is_no_handicap_applied=T.BooleanType(),
    points_multiplier=MULTIPLIER,
    buy_in_override_ammt=MONEY,
    **STAMPS,
)

RAW_SCORES = _struct(
    raw_score_id=T.StringType(),
    event_id=T.StringType(),
    league_id=T.StringType(),
    division=T.StringType(),
    player_name=T.StringType(),
    player_username=T.StringType(),
    raw_score=T.LongType(),
    **STAMPS,
)

HOLE_SCORES = _struct(
    hole_score_id=T.StringType(),
    raw_score_id=T.StringType(),
    hole_number=T.LongType(),
    hole_score=T.LongType(),
    **STAMPS,
)

EVENT_UPDATES = _struct(
    export_url=T.StringType(),
    is_excluded_from_handicap=T.BooleanType(),
    is_no_handicap_applied=T.BooleanType(),
    is_excluded_from_points=T.BooleanType(),
    points_multiplier=MULTIPLIER,
    buy_in_override_ammt=MONEY,
    **STAMPS,
)

PAYOUTS = _struct(
    n_players=T.LongType(),
    position=T.LongType(),
    weight=LADDER_SHARE,
    percentage=LADDER_SHARE,
    payout_percent=T.DecimalType(7, 4),
    create_time=T.TimestampType(),
)

BASE_TABLES = {
    "leagues": LEAGUES,
    "events": EVENTS,
    "raw_scores": RAW_SCORES,
    "hole_scores": HOLE_SCORES,
    "event_updates": EVENT_UPDATES,
    "payouts": PAYOUTS,
}
