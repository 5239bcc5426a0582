"""League settings from JSON files."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.functions.text import join_list, split_list, to_text
from tallyboard.schemas import LEAGUES

# Settings of a league whose entry does not give them.
DEFAULTS = {
    "league_cash_percentage": 0,
    "league_entry_fee": 0,
    "league_is_handicap": False,
    "handicap_minimum_rounds": 0,
    "handicap_rounds_considered": 0,
    "handicap_years_lookback": 0,
    "handicap_base_score": 0,
    "handicap_multiplier": 0,
}


def scan_league_configs(spark: SparkSession, path: str) -> DataFrame:
    """League entries of a JSON list, or of an object that holds the list under "leagues".

    Names and URLs go by two spellings; URLs are a list or one delimited string. Entries
    without a name or a URL are left out.
    """
    texts = spark.read.text(path, wholetext=True)
    entry = T.MapType(T.StringType(), T.StringType())
    as_list = F.from_json("value", T.ArrayType(entry))
    as_object = F.from_json(F.get_json_object("value", "$.leagues"), T.ArrayType(entry))
    is_object = F.ltrim("value").startswith("{")
    return league_entries(
        texts.select(F.explode(F.when(is_object, as_object).otherwise(as_list)).alias("entry"))
    )


def league_entries(entries: DataFrame) -> DataFrame:
    """Normalised league settings from a column `entry` of text maps."""

    def either(first, second):
        # An empty text or list makes room for the other spelling; a blank one does not.
        cell = F.col("entry")[first]
        empty = (cell == "") | (F.regexp_replace(cell, r"\s", "") == "[]")
        return F.coalesce(F.when(~empty, cell), F.col("entry")[second])

    urls = either("league_urls", "urls")
    parsed = F.from_json(F.when(F.ltrim(urls).startswith("["), urls), T.ArrayType(T.StringType()))

    settings = [
        F.coalesce(F.col("entry")[name].try_cast(LEAGUES[name].dataType), F.lit(value).cast(LEAGUES[name].dataType))
        .alias(name)
        for name, value in DEFAULTS.items()
    ]
    return entries.select(
        to_text(either("league_name", "name")).alias("league_name"),
        join_list(F.coalesce(parsed, split_list(urls))).alias("league_urls"),
        *settings,
    ).where(F.col("league_name").isNotNull() & (F.col("league_urls") != ""))


def league_rows(configs: DataFrame, run_time: datetime) -> DataFrame:
    """League rows with an id that depends on the entry only."""
    stamp = F.lit(run_time).cast("timestamp")
    return (
        configs.withColumn("league_id", F.sha2(F.concat_ws("|", "league_name", "league_urls"), 256))
        .withColumns({"create_time": stamp, "update_time": stamp})
        .select(*LEAGUES.names)
    )


def seeded_leagues(leagues: DataFrame, configs: DataFrame, run_time: datetime) -> DataFrame:
    """The stored leagues, or the configured ones if none is stored."""
    return league_rows(configs, run_time) if leagues.isEmpty() else leagues
