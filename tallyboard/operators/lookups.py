"""Lookups on the stored tables and the choice of exports to fetch."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.functions.text import split_list

# Fixed value: how the URL of a downloadable leaderboard ends.
EXPORT_SUFFIX = "leaderboard/export"


def imported_event_urls(events: DataFrame, league_id: str | None = None) -> DataFrame:
    """Distinct export URLs that are already imported, of one league or of all."""
    imported = events.where(F.col("is_imported") == F.lit(True))
    if league_id is not None:
        imported = imported.where(F.col("league_id") == league_id)
    return imported.select("export_url").distinct()


def event_by_url(events: DataFrame, export_url: str) -> DataFrame:
    return events.where(F.col("export_url") == export_url).select("event_id", "is_imported").orderBy("event_id").limit(1)


def league_urls(leagues: DataFrame, league_id: str) -> DataFrame:
    """The schedule URLs of a league, one per row."""
    one = leagues.where(F.col("league_id") == league_id).orderBy("league_name", "league_urls").limit(1)
    return one.select(F.explode(split_list(F.col("league_urls"))).alias("url"))


def league_by_id(leagues: DataFrame, league_id: str) -> DataFrame:
    """The settings of a league under their short names."""
    urls = split_list(F.col("league_urls"))
    return (
        leagues.where(F.col("league_id") == league_id)
        .orderBy("league_name", "league_urls")
        .limit(1)
        .select(
            F.col("league_name").alias("name"),
            F.col("league_is_handicap").alias("is_handicap"),
            F.coalesce(F.get(urls, F.lit(0)), F.lit("")).alias("url"),
            urls.alias("urls"),
            F.col("league_cash_percentage").alias("cash_percentage"),
            F.col("league_entry_fee").alias("entry_fee"),
            "handicap_minimum_rounds",
            "handicap_rounds_considered",
            "handicap_years_lookback",
            "handicap_base_score",
            "handicap_multiplier",
        )
    )


def is_finished(event_end_date: Column, as_of: date) -> Column:
    """An event is over once its end date has passed; without a date it counts as over."""
    return F.coalesce(event_end_date < F.lit(as_of), F.lit(True))


def pending_exports(candidates: DataFrame, events: DataFrame) -> DataFrame:
    """Candidate export links that are not imported yet."""
    exports = candidates.where(F.col("export_url").endswith(EXPORT_SUFFIX))
    return exports.join(imported_event_urls(events), "export_url", "left_anti")
