"""The registered queries: every operator and report on the stand-in tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.standins import AS_OF, PAYOUT_FROM_YEAR, PLAN_AS_OF, RUN_TIME, SEASON, SITE, given, standin
from tallyboard.functions.text import download_time, event_name, join_list, split_list, to_flag
from tallyboard.operators import handicap, lookups, maintain
from tallyboard.operators.matching import join_groups
from tallyboard.operators.placing import SCORE, score_places, with_adjusted_score, with_pot_share
from tallyboard.operators.ranking import value_ranks
from tallyboard.plans import pipeline, season
from tallyboard.plans.adjusted import adjusted_scores
from tallyboard.plans.handicaps import handicaps
from tallyboard.schemas import BASE_TABLES, HOLE_SCORES
from tallyboard.session import tune
from tallyboard.sources import exports, pages
from tallyboard.sources.leagues import league_entries, league_rows
from tallyboard.sources.payouts import field_ladders, payout_ladder, pot_share
from tallyboard.sources.tables import Store, reread, scratch_folder, write_staged

SCANNED = [*exports.REQUIRED, *exports.HOLES[:7]]  # the columns of the export stand-in

REGISTERED: dict[str, Callable[["Tables"], DataFrame]] = {}


# Tables written in this session, by application, input folder and name.
WRITTEN: dict[tuple[str, str, str], tuple[DataFrame, str, int]] = {}


class Tables:
    """The stand-in tables and the derived tables of one run, each described once.

    Tables that others build on are written once per session, as in a rebuild where each
    table reads the stored ones before it. `fresh` writes them anew.
    """

    def __init__(self, spark: SparkSession, folder: str, fresh: bool = False):
        self.spark = tune(spark)
        self.folder = folder
        self.fresh = fresh
        self._made: dict[str, DataFrame] = {}

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def __getattr__(self, name: str) -> DataFrame:
        return self._once(name, lambda: standin(self.spark, self.folder, name))

    def given(self, name: str) -> DataFrame:
        return given(self.spark, self.folder, name)

    @property
    def events(self):
        def make() -> DataFrame:
            before = self.stored("league_events")
            updates = standin(self.spark, self.folder, "event_updates", league_events=before)
            return maintain.apply_event_updates(before, updates, RUN_TIME)

        return self._once("events", make)

    def stored(self, name: str) -> DataFrame:
        """A table as later steps find it: written, not described."""

        partitions = ["year"] if name == "adjusted" else []
        key = (self.spark.sparkContext.applicationId, self.folder, name)

        def find() -> DataFrame:
            if not self.fresh and key in WRITTEN and still_there(*WRITTEN[key]):
                return WRITTEN[key][0]
            made = getattr(self, name)
            folder = write_staged(made, name, *partitions)
            table = reread(made, folder)
            WRITTEN[key] = (table, folder, len(table.inputFiles()))
            return table

        return self._once(f"stored {name}", find)

    @property
    def payouts(self):
        return self._once("payouts", lambda: payout_ladder(self.spark, RUN_TIME))

    @property
    def rounds(self):
        return self._once(
            "rounds",
            lambda: handicap.league_rounds(self.stored("raw_scores"), self.stored("events"), self.stored("leagues"), AS_OF),
        )

    @property
    def handicaps(self):
        return self._once(
            "handicaps",
            lambda: handicaps(self.stored("raw_scores"), self.stored("events"), self.stored("leagues"), AS_OF, RUN_TIME),
        )

    @property
    def scored(self):
        return with_adjusted_score(self.stored("raw_scores"), self.stored("handicaps"))

    @property
    def places(self):
        return self._once(
            "places",
            lambda: with_pot_share(score_places(self.scored), self.payouts),
        )

    @property
    def adjusted(self):
        return self._once(
            "adjusted",
            lambda: adjusted_scores(
                self.stored("raw_scores"),
                self.stored("handicaps"),
                self.payouts,
                self.stored("events"),
                self.stored("leagues"),
                PAYOUT_FROM_YEAR,
            ),
        )

    @property
    def season_events(self):
        return self._once(
            "season_events",
            lambda: season.season_event_summary(
                self.stored("events"), self.stored("adjusted"), self.stored("leagues"), SEASON
            ),
        )

    @property
    def season_players(self):
        return self._once(
            "season_players",
            lambda: season.season_players_summary(self.stored("adjusted"), self.stored("handicaps"), SEASON),
        )

    @property
    def plan(self):
        downloads = self.candidates.where(F.col("export_url").endswith(lookups.EXPORT_SUFFIX))
        return exports.import_plan(downloads, self.stored_events, PLAN_AS_OF)


def still_there(table: DataFrame, folder: str, files: int) -> bool:
    """Whether a written table still has all its files; someone may have cleared the folder."""
    try:
        return len(reread(table, folder).inputFiles()) == files
    except AnalysisException:
        return False


def portable(table: DataFrame) -> DataFrame:
    """Types both engines hand over alike: decimals as doubles, dates and times as text."""

    def plain(field):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType)):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return column.cast("bigint").alias(field.name)
        return column

    return table.select(*[plain(field) for field in table.schema])


def registered(make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REGISTERED[make.__name__] = make
    return make


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(make):
        return lambda spark, folder: portable(make(Tables(spark, folder)))

    return {name: runner(make) for name, make in REGISTERED.items()}


def rebuild(spark: SparkSession, folder: str) -> None:
    """Write every derived table anew from the given ones."""
    tables = Tables(spark, folder, fresh=True)
    for make in (season_event_summary, season_players_summary, season_log, season_hole_scores):
        write_staged(make(tables), make.__name__)


# --- handicaps ---------------------------------------------------------------


@registered
def eligible_rounds(t):
    return t.rounds.where("counts").select(
        "raw_score_id", "league_id", "raw_score", "player_username", "event_end_date"
    )


@registered
def prior_round_count(t):
    return handicap.receiving_rounds(t.rounds, handicap.player_days(t.rounds)).select("raw_score_id", "earlier_rounds")


@registered
def handicap_rounds(t):
    return handicap.considered_rounds(t.rounds).select("raw_score_id", "recency", "used_raw_score", "used_date")


@registered
def handicaps_(t):
    return t.handicaps.drop("create_time")


REGISTERED["handicaps"] = REGISTERED.pop("handicaps_")


@registered
def current_handicap(t):
    return handicap.latest_per_player(t.handicaps).select(
        "league_id", "player_username", "next_handicap", "next_raw_scores_considered"
    )


# --- places, points, prize money --------------------------------------------


@registered
def scored_rounds(t):
    return (
        t.raw_scores.select("raw_score_id", "event_id", "league_id", "raw_score")
        .join(t.events.select("event_id", "event_name", "event_end_date"), "event_id")
        .join(t.leagues.select("league_id", "league_name"), "league_id")
        .select("raw_score_id", "league_id", "event_name", "event_end_date", "league_name", "raw_score")
    )


@registered
def event_placing(t):
    return join_groups(t.scored, score_places(t.scored), SCORE).select(
        "raw_score_id", "adjusted_score", "place", "tie_count", "num_players"
    )


@registered
def payout_shares(t):
    return join_groups(t.scored, t.places, SCORE).select("raw_score_id", "split_percentage")


@registered
def payout_table(t):
    """The rungs of every field size that occurs; fields that the ladder does not know are there without any."""
    fields = t.places.select(F.col("num_players").alias("n_players"))
    return field_ladders(fields, t.payouts).select("n_players", "position", "weight", "percentage", "payout_percent")


@registered
def payout_large_fields(t):
    """Pot shares where all rounds of a league and year are one field, beyond the ladder's limit and below it."""
    days = t.league_events.select("event_id", F.year("event_end_date").alias("year"))
    rounds = t.raw_scores.where("raw_score is not null").join(days, "event_id")
    places = value_ranks(rounds, ["league_id", "year"], "raw_score")
    shares = {
        "share": pot_share(F.col("place"), F.col("tie_count"), F.col("group_size"), None),
        "limited_share": pot_share(F.col("place"), F.col("tie_count"), F.col("group_size"), 3000),
    }
    return places.select("league_id", "year", "raw_score", "place", "tie_count", "group_size", *[c.alias(n) for n, c in shares.items()])


def _adjusted(t):
    return t.adjusted


REGISTERED["adjusted_scores"] = _adjusted


# --- season reports ----------------------------------------------------------


@registered
def season_event_summary(t):
    return t.season_events


@registered
def season_players_summary(t):
    return t.season_players


@registered
def season_log(t):
    return season.season_log(t.season_players, t.season_events, t.leagues, t.stored("adjusted"), SEASON)


@registered
def season_hole_scores(t):
    leagues = t.stored("leagues")
    return season.season_hole_scores(t.stored("adjusted"), t.stored("season_events"), leagues, t.hole_scores, SEASON)


# --- lookups and intake ------------------------------------------------------


@registered
def imported_event_urls(t):
    return lookups.imported_event_urls(t.league_events)


@registered
def league_lookup(t):
    return lookups.league_by_id(t.leagues, "BUILDING").select(
        "name", "is_handicap", "url", "cash_percentage", "entry_fee", "handicap_rounds_considered"
    )


@registered
def finished_events(t):
    return t.league_events.where(lookups.is_finished(F.col("event_end_date"), PLAN_AS_OF)).select("event_id")


@registered
def pending_exports(t):
    return lookups.pending_exports(t.candidates, t.league_events).select("export_url", "league_id")


@registered
def import_plan(t):
    return t.plan.select("export_url", "is_new", "action", "event_id")


@registered
def event_by_url(t):
    url = f"{SITE}/events/BUILDING-2001-03-01/leaderboard/export"
    return lookups.event_by_url(t.league_events, url)


@registered
def league_urls(t):
    return lookups.league_urls(t.leagues, "BUILDING")


@registered
def scanned_exports(t):
    """All export rows, written as CSV files with quotes, commas and line breaks in cells, and scanned.

    The folder's name has blanks; that of each file's own folder comes back in `file_path`.
    """
    cells = t.awkward_exports.select("league_id", *SCANNED)
    folder = f"{scratch_folder(t.spark)}/exports of {uuid.uuid4().hex}"
    cells.write.partitionBy("league_id").csv(
        folder, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    found = exports.scan_exports(t.spark, f"{folder}/*")
    league = F.regexp_extract("file_path", "exports of [0-9a-f]+/league_id=([^/]*)/[^/]*$", 1)
    return found.select(league.alias("league_id"), *SCANNED)


@registered
def clean_scores(t):
    return exports.clean_scores(t.exports)


@registered
def hole_unpivot(t):
    return exports.hole_unpivot(t.exports)


@registered
def event_rows(t):
    """Rows for the events of the exports that are not stored yet."""
    files = t.exports.groupBy("event_id").agg(F.min("file_path").alias("file_path"))
    downloads = (
        t.league_events.select("event_id", "export_url", "league_id", "event_end_date")
        .join(files, "event_id")
        .drop("event_id")
    )
    plan = exports.import_plan(downloads, t.stored_events, PLAN_AS_OF)
    return exports.event_rows(exports.turnout(t.exports), plan, RUN_TIME).select(
        "event_id",
        "league_id",
        "event_name",
        "event_end_date",
        "export_url",
        "num_players",
        "download_date",
        "is_imported",
    )


@registered
def round_ids(t):
    """The round ids of all export rows."""
    files = t.exports.select("file_path", "event_id", "league_id").distinct()
    plan = files.select(
        "file_path", F.col("file_path").alias("export_url"), "event_id", "league_id", F.lit("full").alias("action")
    )
    cells = t.exports.drop("raw_score_id", "event_id", "league_id")
    # Every row twice: copies are rounds of their own.
    return exports.identified_rows(cells.unionByName(cells), plan).select("file_path", "raw_score_id")


@registered
def league_configs(t):
    given_settings = [c for c in t.config_cells.columns if c != "segment"]
    entry = F.map_from_arrays(F.array(*[F.lit(c) for c in given_settings]), F.array(*given_settings))
    rows = league_rows(league_entries(t.config_cells.select(entry.alias("entry"))), RUN_TIME)
    return rows.select(
        "league_name", "league_urls", "league_entry_fee", "league_is_handicap", "handicap_rounds_considered"
    )


@registered
def file_name_parts(t):
    path = F.col("file_path")
    files = t.exports.select("file_path").distinct()
    return files.select("file_path", event_name(path).alias("event_name"), download_time(path).alias("download_date"))


@registered
def parse_url_list(t):
    return t.leagues.select("league_id", F.explode(split_list(F.col("league_urls"))).alias("url"))


@registered
def format_url_list(t):
    return t.leagues.select("league_id", join_list(F.split("league_urls", r"\|")).alias("league_urls"))


@registered
def parse_flags(t):
    spelled = (
        F.when(F.col("role") == "user", F.lit(" Yes "))
        .when(F.col("turn") % 2 == 1, F.lit("OFF"))
        .otherwise(F.col("role"))
    )
    return t.given("conversations").select(
        "conv_id", "turn", to_flag(F.col("text")).alias("flag"), to_flag(spelled, None).alias("by_user")
    )


# --- upkeep ------------------------------------------------------------------


@registered
def apply_event_updates(t):
    return t.events.select("event_id", "league_id", "event_end_date", "export_url", *maintain.OVERRIDES, "update_time")


@registered
def mark_imported(t):
    over = t.league_events.where(lookups.is_finished(F.col("event_end_date"), PLAN_AS_OF))
    return maintain.mark_imported(t.league_events, over.select("event_id"), RUN_TIME).select("event_id", "is_imported")


@registered
def update_file_metadata(t):
    moved = t.league_events.where(F.month("event_end_date") == 3).select(
        "event_id",
        F.concat(F.lit("moved/"), "file_name").alias("file_name"),
        F.lit(None).cast("string").alias("file_path"),
    )
    return maintain.update_file_metadata(t.league_events, moved, RUN_TIME).select("event_id", "file_name", "file_path")


@registered
def update_league(t):
    dearer = t.leagues.where("league_is_handicap").withColumn(
        "league_entry_fee", (F.col("league_entry_fee") + 1).cast("decimal(10,2)")
    )
    return maintain.update_leagues(t.leagues, dearer, RUN_TIME).select(
        "league_id", "league_name", "league_entry_fee", "handicap_rounds_considered"
    )


@registered
def conform(t):
    """Hole scores in another layout, brought to the declared one."""
    found = t.hole_scores.select(
        "raw_score_id",
        F.concat("hole_number", F.lit("")).alias("hole_number"),
        F.when(F.col("hole_score") % 10 == 0, "-").otherwise(F.col("hole_score").cast("string")).alias("hole_score"),
        F.lit(1).alias("extra"),
    )
    return maintain.conform(found, HOLE_SCORES).select("hole_score_id", "raw_score_id", "hole_number", "hole_score")


def _kept_events(t):
    return t.league_events.where(F.month("event_end_date") != 3)


@registered
def prune_raw_scores(t):
    return maintain.prune_raw_scores(t.raw_scores, _kept_events(t)).select("raw_score_id", "event_id")


@registered
def prune_hole_scores(t):
    kept = maintain.prune_raw_scores(t.raw_scores, _kept_events(t))
    return maintain.prune_hole_scores(t.hole_scores, kept).select("raw_score_id", "hole_number", "hole_score")


# --- web pages ---------------------------------------------------------------


@registered
def page_links(t):
    return pages.page_links(t.mixed_pages)


@registered
def awkward_links(t):
    """Links whose tags have attributes that look like others, and what only looks like a link."""
    return pages.page_links(t.awkward_pages)


@registered
def iso_end_dates(t):
    """End dates in all forms that are taken, and a near miss, one page each."""
    day = F.date_add(F.lit("1999-12-25").cast("date"), (F.col("page_id") % 4000).cast("int"))
    year, week, weekday = F.extract(F.lit("YEAROFWEEK"), "day"), F.weekofyear("day"), F.weekday("day") + 1
    forms = [
        F.date_format("day", "yyyy-MM-dd"),
        F.date_format("day", "yyyyMMdd"),
        F.format_string("%d-W%02d-%d", year, week, weekday),
        F.format_string("%dW%02d%d", year, week, weekday),
        F.format_string("%d-W%02d", year, week),
        F.date_format("day", "yyyy-MMdd"),
    ]
    told = F.get(F.array(*forms), (F.col("page_id") % 6).cast("int"))
    html = F.concat(F.lit('<time datetime="1990-01-01"></time><time title="datetime=2" datetime='), told, F.lit(">x</time>"))
    return pages.page_end_dates(t.pages.select("page_id", day.alias("day")).select("page_id", html.alias("html")))


@registered
def page_links_resolved(t):
    return pages.resolved_links(t.mixed_pages)


@registered
def event_links(t):
    return pages.event_links(t.event_pages, SITE, 2023)


@registered
def page_end_dates(t):
    return pages.page_end_dates(t.event_pages)


@registered
def orphan_raw_scores(t):
    return maintain.orphan_raw_scores(t.raw_scores, _kept_events(t)).groupBy("league_id").count()


def _older_run(t) -> pipeline.Run:
    """A store whose rounds have an older layout: scores as text, some unreadable, and a column unknown today."""
    store = Store(t.spark, f"{scratch_folder(t.spark)}/store-{uuid.uuid4().hex}")
    run = pipeline.Run(store, "first", RUN_TIME)
    score = F.when(F.col("raw_score") % 10 == 3, F.concat(F.col("raw_score").cast("string"), F.lit(" shots")))
    older = t.raw_scores.withColumn("raw_score", F.coalesce(score, F.col("raw_score").cast("string")))
    note = F.when(F.col("division") == "Division 1", F.concat(F.lit("of "), "player_name"))
    run.append("raw_scores", older.withColumn("note", note).where("league_id <> 'BUILDING'"))
    run.append("raw_scores", t.raw_scores.select(*BASE_TABLES["raw_scores"].names).where("league_id = 'BUILDING'"))
    run.append("hole_scores", t.hole_scores)
    run.replace("events", _kept_events(t))
    return run


@registered
def misfits(t):
    """Cells of stored folders that today's layout does not keep, by column, before and after a prune."""
    run = _older_run(t)
    pipeline.inspect(run)
    noted = t.spark.read.parquet(*run.folders["misfits"]).groupBy("column", "reason").agg(F.count("value").alias("cells"))
    pipeline.prune(run)
    pipeline.inspect(run)  # finds nothing new
    stored = [folder for folder in run.folders["raw_scores"] if "note" in t.spark.read.parquet(folder).columns]
    rounds = t.spark.read.parquet(*stored)
    still = rounds.select(
        F.count("note").alias("note"), F.count_if(F.col("raw_score").endswith("shots")).alias("raw_score")
    ).select(F.explode(F.create_map(F.lit("note"), "note", F.lit("raw_score"), "raw_score")).alias("column", "left"))
    rows = t.spark.read.parquet(*run.folders["misfits"]).groupBy("column").agg(F.count("*").alias("noted"))
    return noted.join(still, "column").join(rows, "column")


@registered
def pruned_counts(t):
    """How many rows a prune of the stored tables takes."""
    run = _older_run(t)
    pipeline.prune(run)
    return t.spark.createDataFrame(sorted(run.pruned.items()), "table_name string, pruned long")


@registered
def whole_run(t):
    """A run from files to stored tables: exports with untidy headers, league settings, facts by league and year."""
    place = f"{scratch_folder(t.spark)}/run-{uuid.uuid4().hex}"
    untidy = {"division": "Division", "name": "NAME!", "username": " User-name", "round_total_score": "Round_Total_Score"}
    cells = t.exports.select(F.col("event_id").alias("event"), *[F.col(c).alias(untidy.get(c, c.title())) for c in SCANNED])
    cells.repartition("event").write.partitionBy("event").csv(
        f"{place}/exports", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    files = exports.export_files(t.spark, f"{place}/exports/*")
    of_event = files.withColumn("event_id", F.regexp_extract("file_path", "event=([^/]*)/", 1))
    notes = of_event.join(t.league_events.select("event_id", "export_url", "league_id", "event_end_date"), "event_id").drop("event_id")
    layouts = exports.export_layouts(t.spark, f"{place}/exports/*")
    settings = [c for c in t.config_cells.columns if c != "segment"]
    entry = F.map_from_arrays(F.array(*[F.lit(c) for c in settings]), F.array(*settings))
    run = pipeline.run_pipeline(
        t.spark,
        f"{place}/store",
        RUN_TIME,
        downloads=notes,
        export_rows=exports.scan_exports(t.spark, f"{place}/exports/*", layouts),
        export_files=files,
        export_faults=exports.export_faults(t.spark, f"{place}/exports/*", layouts),
        league_configs=league_entries(t.config_cells.select(entry.alias("entry"))),
        derive=False,
    )
    events = run.table("events").where("is_imported").select("event_id", F.year("event_end_date").alias("year"))
    rounds = run.table("raw_scores").join(events, "event_id")
    holes = run.table("hole_scores").groupBy("raw_score_id").agg(F.count("*").alias("holes"), F.sum("hole_score").alias("strokes"))
    return (
        rounds.join(holes, "raw_score_id", "left")
        .groupBy("league_id", "year")
        .agg(
            F.count("*").alias("rounds"),
            F.sum("raw_score").alias("total"),
            F.sum("holes").alias("holes"),
            F.sum("strokes").alias("strokes"),
            F.count_distinct("event_id").alias("events"),
            F.max("update_time").alias("updated"),
        )
        .withColumn("leagues", F.lit(run.table("leagues").count()))
    )
