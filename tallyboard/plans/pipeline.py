"""One run: clean up, import finished events, apply overrides, rebuild the derived tables."""

from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyboard.functions.text import plain_path
from tallyboard.operators import maintain
from tallyboard.operators.lookups import pending_exports
from tallyboard.plans import season as reports
from tallyboard.plans.adjusted import adjusted_scores
from tallyboard.plans.handicaps import handicaps
from tallyboard.schemas import BASE_TABLES
from tallyboard.session import tune
from tallyboard.sources import exports as intake
from tallyboard.sources.leagues import seeded_leagues
from tallyboard.sources.payouts import payout_ladder
from tallyboard.sources.tables import Store, folder_parts, layout_mark, reread, staged


@dataclass
class Run:
    """A run in the making: the folders each table has so far."""

    store: Store
    run_id: str
    run_time: datetime
    number: int = 1
    folders: dict[str, list[str]] = field(default_factory=dict)
    pruned: dict[str, int] = field(default_factory=dict)

    def table(self, name: str, year: int | None = None) -> DataFrame:
        """A table; of one kept by year only that year's folders, and those written before years were kept apart."""
        folders = self.folders.get(name, [])
        if year is not None:
            folders = [folder for folder in folders if folder_parts(folder)[2] in (None, str(year))]
        return self.store.read(name, folders)

    def replace(self, name: str, table: DataFrame, *partitions: str) -> DataFrame:
        self.folders[name] = [self.store.write(table, name, self.run_id, *partitions)]
        return reread(table, self.folders[name][0])

    def append(self, name: str, table: DataFrame) -> None:
        self.folders[name] = [*self.folders.get(name, []), self.store.write(table, name, self.run_id)]


    def append_by_year(self, name: str, table: DataFrame) -> None:
        self.folders[name] = [*self.folders.get(name, []), *self.store.write_by_year(table, name, self.run_id)]


def begin(store: Store, run_time: datetime) -> Run:
    tune(store.spark)
    number, folders = store.last()
    return Run(store, run_time.strftime("%Y%m%dT%H%M%S%f"), run_time, number + 1, folders)


DRIFT = "table_name string, folder string, missing array<string>, unknown array<string>, retyped array<string>, create_time timestamp"


def _drift_row(run: Run, name: str, folder: str, schema: StructType) -> tuple:
    drift = maintain.schema_drift(schema, BASE_TABLES[name])
    return (name, folder, drift["missing"], drift["unknown"], drift["retyped"], run.run_time)


def inspect(run: Run) -> None:
    """Note what folders of an older layout hold that the declared one does not keep, once per folder.

    `schema_drift` gets a row per folder, `misfits` a row per cell with its folder and the reason. The folders
    stay as they are; only how they are read leaves such cells out.
    """
    spark = run.store.spark
    seen: set[tuple[str, str]] = set()
    if run.folders.get("schema_drift"):
        noted = spark.read.schema(DRIFT).parquet(*run.folders["schema_drift"])
        seen = {tuple(row) for row in noted.select("table_name", "folder").collect()}
    rows, parts = [], []
    for name, declared in BASE_TABLES.items():
        for folder in run.folders.get(name, []):
            if f"/{layout_mark(declared)}/" in folder or (name, folder) in seen:
                continue
            table = spark.read.parquet(folder)
            rows.append(_drift_row(run, name, folder, table.schema))
            origin = [F.lit(name).alias("table_name"), F.lit(folder).alias("folder")]
            parts.append(maintain.misfit_cells(table, declared).select(*origin, "*"))
    if rows:
        run.append("schema_drift", spark.createDataFrame(rows, DRIFT))
        run.append("misfits", reduce(DataFrame.unionByName, parts))


def _prune(run: Run, name: str, orphans_of, kept_of) -> None:
    """Rewrite the folders that hold orphans, each in its own layout; the others stay as they are.

    How many rows went is what the old folders held more than the new ones; both counts come from the
    files' footers.
    """
    run.pruned[name] = 0
    folders = run.folders.get(name, [])
    if not folders:
        return
    spark = run.store.spark
    found = orphans_of(run.store.read(name, folders, marked=True)).select("place").distinct()
    named = {row["folder"] for row in run.store.places(folders).join(found, "place").select("folder").distinct().collect()}
    alike: dict[tuple[str, str | None], list[str]] = {}
    for folder in folders:
        mark, own_name, year = folder_parts(folder)
        if own_name in named:
            alike.setdefault((mark, year), []).append(folder)
    for (mark, year), touched in alike.items():
        if mark == layout_mark(BASE_TABLES[name]):
            kept = kept_of(run.store.read(name, touched))
        else:
            # The declared columns decide which rows stay; what is written is the row as it was.
            whole = maintain.conform(spark.read.parquet(*touched), BASE_TABLES[name], F.struct("*").alias("whole"))
            kept = kept_of(whole).select("whole.*")
        written = run.store.write(kept, name, run.run_id, year=year)
        run.folders[name] = [*[folder for folder in run.folders[name] if folder not in touched], written]
        run.pruned[name] += spark.read.parquet(*touched).count() - spark.read.schema(kept.schema).parquet(written).count()
        if mark != layout_mark(BASE_TABLES[name]):
            row = _drift_row(run, name, written, kept.schema)  # its misfits are noted under the old folders
            run.append("schema_drift", spark.createDataFrame([row], DRIFT))


def prune(run: Run) -> None:
    """Drop rounds without an event, then hole scores without a round.

    Rounds come with their events, so there is nothing to drop unless an event has vanished
    since the last run; then only the small lists of event ids are read.
    """
    events = run.table("events")
    if run.folders.get("known_events"):
        known = run.store.spark.read.schema("event_id string").parquet(*run.folders["known_events"])
        if known.join(events, "event_id", "left_anti").isEmpty():
            run.pruned.update(raw_scores=0, hole_scores=0)
            return
    _prune(
        run,
        "raw_scores",
        lambda rows: maintain.orphan_raw_scores(rows, events),
        lambda rows: maintain.prune_raw_scores(rows, events),
    )
    rounds = run.table("raw_scores")
    _prune(
        run,
        "hole_scores",
        lambda rows: maintain.orphan_hole_scores(rows, rounds),
        lambda rows: maintain.prune_hole_scores(rows, rounds),
    )


def one_file_per_url(downloads: DataFrame) -> DataFrame:
    """If an export was saved more than once, the last file name wins."""
    others = [c for c in downloads.columns if c not in ("export_url", "file_path")]
    return (
        downloads.groupBy("export_url")
        .agg(F.max(F.struct("file_path", *others)).alias("last"))
        .select("export_url", "last.*")
    )


def import_exports(
    run: Run,
    downloads: DataFrame,
    rows: DataFrame,
    as_of: date,
    present: DataFrame | None = None,
    faults: DataFrame | None = None,
) -> None:
    """Load the downloaded exports that are new.

    `downloads` says which file came from which URL, `rows` holds their cells. Events that
    still run are noted without scores. A file without rows imports nothing; it goes to the
    table `import_faults` with the reason. With the files that are `present` given, a note
    without its file ends the run.
    """
    events = run.table("events")
    files = staged(intake.turnout(rows), "export_turnout")
    notes = downloads.withColumn("file_path", plain_path(F.col("file_path")))
    wanted = one_file_per_url(pending_exports(notes, events))
    if present is not None:
        intake.check_files(wanted, present)
    run.append("import_faults", intake.import_faults(wanted, files, faults, run.run_time))
    plan = intake.import_plan(wanted, events, as_of).join(files, "file_path", "left_semi")
    plan = staged(plan.where(F.col("action") != "skip"), "import_plan")
    years = plan.select("event_id", F.coalesce(F.year("event_end_date"), F.lit(0)).alias("year")).distinct()
    scores = staged(intake.identified_rows(rows, plan).join(years, "event_id"), "identified_rows")
    run.append_by_year("hole_scores", intake.hole_score_rows(scores, run.run_time))
    run.append_by_year("raw_scores", intake.raw_score_rows(scores, run.run_time))

    loaded = plan.where(F.col("action") == "full")
    names = loaded.select("event_id", F.substring_index("file_path", "/", -1).alias("file_name"), "file_path")
    known = events.unionByName(intake.event_rows(files, plan, run.run_time))
    marked = maintain.mark_imported(known, loaded.select("event_id"), run.run_time)
    run.replace("events", maintain.update_file_metadata(marked, names, run.run_time))


def rebuild(run: Run, as_of: date, season: int, payout_from_year: int) -> None:
    """Work out the derived tables, each from the written ones before it. Any failure ends the run."""
    events = run.replace(
        "events", maintain.apply_event_updates(run.table("events"), run.table("event_updates"), run.run_time)
    )
    leagues, payouts, rounds = run.table("leagues"), run.table("payouts"), run.table("raw_scores")
    strokes = run.replace("handicaps", handicaps(rounds, events, leagues, as_of, run.run_time))
    adjusted = run.replace(
        "adjusted_scores", adjusted_scores(rounds, strokes, payouts, events, leagues, payout_from_year), "year"
    )
    calendar = run.replace(
        "season_event_summary", reports.season_event_summary(events, adjusted, leagues, season)
    )
    players = run.replace("season_players_summary", reports.season_players_summary(adjusted, strokes, season))
    run.replace("season_log", reports.season_log(players, calendar, leagues, adjusted, season))
    run.replace(
        "season_hole_scores_summary",
        reports.season_hole_scores(adjusted, calendar, leagues, run.table("hole_scores", season), season),
    )


def run_pipeline(
    spark: SparkSession,
    root: str,
    run_time: datetime,
    downloads: DataFrame | None = None,
    export_rows: DataFrame | None = None,
    export_files: DataFrame | None = None,
    export_faults: DataFrame | None = None,
    league_configs: DataFrame | None = None,
    season: int | None = None,
    payout_from_year: int = 2016,
    derive: bool = True,
) -> Run:
    """The whole run, committed at the end. The run's date decides what is over and in season.

    Without `derive` it stops after the import; the derived tables stay as they are.
    """
    run = begin(Store(spark, root), run_time)
    inspect(run)
    prune(run)
    if not run.folders.get("payouts"):
        run.replace("payouts", payout_ladder(spark, run_time))
    if league_configs is not None:
        stored = run.table("leagues")
        if stored.isEmpty():
            run.replace("leagues", seeded_leagues(stored, league_configs, run_time))
    if downloads is not None and export_rows is not None:
        import_exports(run, downloads, export_rows, run_time.date(), export_files, export_faults)
    if derive:
        rebuild(run, run_time.date(), season or run_time.year, payout_from_year)
    run.replace("known_events", run.table("events").select("event_id").distinct())
    run.store.commit(run.number, run.run_id, run.run_time, run.folders)
    return run
