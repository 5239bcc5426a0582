"""Leaderboard exports: scan the files and shape them into event, round and hole rows.

Exports differ in their columns (9, 18 or more holes, extra columns in any order), so one read cannot take its
column names from the first file. All files are read as lines; the header row of each file says which cell is
which. A first scan gives one row per file: its header, and whether a quoted cell of it breaks a line. Whole files
are read in one piece only where that is so; all others are read line by line, however large.
"""

import re
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.functions.text import (
    LAST_HOLE,
    column_key,
    download_time,
    event_name,
    hole_number,
    plain_path,
    to_int,
    to_text,
)
from tallyboard.operators.lookups import is_finished
from tallyboard.operators.maintain import CLEARED
from tallyboard.schemas import EVENTS, HOLE_SCORES, RAW_SCORES
from tallyboard.sources.tables import reread, write_staged

# The columns an export must have.
REQUIRED = ["division", "name", "username", "round_total_score"]
HOLES = [f"hole_{n}" for n in range(1, LAST_HOLE + 1)]
CELLS = [*REQUIRED, *HOLES]


class MissingColumns(ValueError):
    """An export lacks columns it must have."""


def named_export(table: DataFrame, origin: list[str]) -> DataFrame:
    """An export that comes as a table with named columns (Parquet, JSON lines).

    `origin` names the columns that say which file a row is from; they are kept as they are.
    """
    spark = table.sparkSession
    # One rule for header names, wherever they come from.
    names = spark.createDataFrame([(name,) for name in table.columns], "name string")
    keys = dict(names.select("name", column_key(F.col("name"))).collect())
    kept = {}
    for name in table.columns:
        key = keys[name]
        if name not in origin and key in CELLS and key not in kept:
            kept[key] = F.col(f"`{name}`").cast("string").alias(key)
    missing = sorted(set(REQUIRED) - kept.keys())
    if missing:
        raise MissingColumns(f"Missing required columns: {', '.join(missing)}")
    return table.select(*origin, *[kept[c] for c in CELLS if c in kept])


# A cell is quoted, with quotes inside it doubled, or runs to the next comma or line end.
QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
RECORD = rf"(?:{QUOTED}[^,\r\n]*+|[^,\r\n]*+)(?:,(?:{QUOTED}[^,\r\n]*+|[^,\r\n]*+))*+"
CELL = r',(?:"([^"]*+(?:""[^"]*+)*+)"[^,]*+|([^,]*+))'


def record_cells(record: Column) -> Column:
    """The cells of one record; empty ones are NULL."""
    # Every cell begins with a comma then.
    led = F.concat(F.lit(","), record)
    quoted, plain = (F.regexp_extract_all(led, F.lit(CELL), F.lit(group)) for group in (1, 2))
    # At most one of the two is not empty.
    taken = F.zip_with(quoted, plain, lambda a, b: F.concat(F.replace(a, F.lit('""'), F.lit('"')), b))
    cells = F.when(F.contains(record, F.lit('"')), taken).otherwise(F.split(record, ",", -1))
    return F.transform(cells, lambda cell: F.nullif(cell, F.lit("")))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All lines that are not blank, with the URI of their file and whether they are of its first block.

    What is the same for all lines of a file, such as its plain path, is worked out per file, not here.
    """
    return (
        spark.read.text(path)
        .where(F.col("value").rlike(r"\S"))
        .select(F.col("_metadata.file_path").alias("origin"), "value", (F.col("_metadata.file_block_start") == 0).alias("early"))
    )


def _origin(uri: str = "_metadata.file_path") -> Column:
    return plain_path(F.col(uri), F.lit(True)).alias("file_path")


def names_required(record: Column) -> Column:
    """Whether the key of the whole record holds that of a required column, told without making the key."""
    spelt = ["[^a-z0-9_]*".join(name) for name in REQUIRED]
    return F.lower(record).rlike("|".join(spelt))


def _torn_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The records of files in which cells break lines, each file read in one piece: (file_path, place, cells)."""
    if not paths:
        return spark.createDataFrame([], "file_path string, place int, cells array<string>")
    # A mark of byte order is no part of the first cell.
    text = F.regexp_replace("value", "^\ufeff", "")
    records = F.regexp_extract_all(text, F.lit(RECORD), F.lit(0))
    found = spark.read.text([re.sub(r"([\\\[\]{}*?])", r"\\\1", path) for path in paths], wholetext=True).select(_origin(), F.posexplode(records).alias("place", "record"))
    return found.where(F.col("record").rlike(r"\S")).select("file_path", "place", record_cells(F.col("record")).alias("cells"))


def _headers(rows: DataFrame) -> DataFrame:
    """The header of each file: of its candidate rows, the one that names most of the required columns."""
    required = F.array(*[F.lit(name) for name in REQUIRED])
    known = F.size(F.array_intersect("keys", required))
    return (
        rows.withColumn("keys", F.transform("cells", column_key))
        .withColumn("known", known)
        .where(F.col("known") > 0)
        .groupBy("file_path")
        .agg(F.max(F.struct("known", "keys", "cells")).alias("best"))
        .select("file_path", "best.known", "best.keys", F.col("best.cells").alias("header"))
    )


def _written(table: DataFrame, name: str) -> DataFrame:
    return reread(table, write_staged(table, name))


class ExportLayouts(NamedTuple):
    """What a first scan tells of the exports at a place."""

    path: str | list[str]
    # (origin, file_path, known, keys, header, torn), one row per file with rows; origin is its URI.
    files: DataFrame
    # Paths of the files in which cells break lines, as the file system names them.
    torn: list[str]


def export_layouts(spark: SparkSession, path: str | list[str]) -> ExportLayouts:
    """Scan the exports for their headers, once for rows and faults.

    A line with an odd number of quotes opens or ends a cell that goes on in another line. Paths of such files
    come to the driver, which has listed all files anyway.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = _lines(spark, path)
    # Only lines that name a required column are taken apart.
    candidate = F.col("early") & names_required(F.col("value"))
    cells = F.when(candidate, record_cells(F.col("value")))
    keys = F.transform(cells, column_key)
    known = F.size(F.array_intersect(keys, F.array(*[F.lit(name) for name in REQUIRED])))
    marked = lines.select("origin", (quotes % 2 == 1).alias("odd"), cells.alias("cells"), keys.alias("keys"), known.alias("known"))
    best = F.max(F.when(F.col("known") > 0, F.struct("known", "keys", "cells")))
    found = marked.groupBy("origin").agg(F.max("odd").alias("torn"), best.alias("best"))
    files = _written(found.select("origin", _origin("origin"), "torn", "best"), "export_layouts")
    torn = [row.file_path for row in files.where("torn").select("file_path").collect()]
    whole = _headers(_torn_records(spark, torn)).withColumn("torn", F.lit(True))
    sound = files.where("not torn").select("origin", "file_path", "best.known", "best.keys", F.col("best.cells").alias("header"), "torn")
    lost = files.where("torn").select("origin", "file_path").join(whole, "file_path", "left").withColumn("torn", F.lit(True))
    return ExportLayouts(path, sound.unionByName(lost) if torn else sound, torn)


def export_faults(spark: SparkSession, path: str | list[str], layouts: ExportLayouts | None = None) -> DataFrame:
    """Files that cannot be imported, with the required columns they lack."""
    layouts = layouts or export_layouts(spark, path)
    found = F.coalesce("keys", F.array().cast("array<string>"))
    lacking = F.array_sort(F.array_except(F.array(*[F.lit(name) for name in REQUIRED]), found))
    return layouts.files.select("file_path", lacking.alias("missing")).where(F.size("missing") > 0)


def scan_exports(spark: SparkSession, path: str | list[str], layouts: ExportLayouts | None = None) -> DataFrame:
    """All rows of all sound CSV exports with their cells under normalised names.

    Cells may hold commas, quotes and line breaks if they are quoted; empty ones are NULL, blank lines are no rows.
    Files that lack a required column are left out; export_faults lists them. A file without
    rows gives no rows. `layouts` saves the first scan where it was made already.
    """
    layouts = layouts or export_layouts(spark, path)
    places = [F.array_position("keys", name).alias(f"at_{name}") for name in CELLS]
    wanted = layouts.files.where(F.col("known") == len(REQUIRED))
    rows = (
        _lines(spark, path)
        .join(wanted.where("not torn").select("origin", "file_path", "header", *places), "origin")
        .select("file_path", "header", record_cells(F.col("value")).alias("cells"), names_required(F.col("value")).alias("named"), *[f"at_{name}" for name in CELLS])
    )
    if layouts.torn:
        torn = _torn_records(spark, layouts.torn).drop("place").withColumn("named", F.lit(True))
        rows = rows.unionByName(torn.join(wanted.where("torn").select("file_path", "header", *places), "file_path"))

    def cell(name: str) -> Column:
        # array_position counts from 1 and gives 0 for a column the file does not have.
        return F.get("cells", (F.col(f"at_{name}") - 1).cast("int")).alias(name)

    # Only a line that names a required column can be the header; the others are taken apart once, for their cells.
    is_header = F.when(F.col("named"), F.col("cells").eqNullSafe(F.col("header"))).otherwise(F.lit(False))
    return rows.where(~is_header).select("file_path", *[cell(name) for name in CELLS])


def export_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files at a place, none of them opened."""
    files = spark.read.format("binaryFile").load(path).select("path")
    return files.select(plain_path(F.col("path"), F.lit(True)).alias("file_path"))


class MissingFiles(LookupError):
    """Notes name files that are not there."""


def check_files(downloads: DataFrame, files: DataFrame) -> None:
    """Fail if a note's file is not among the files found."""
    lost = downloads.select("file_path").join(files, "file_path", "left_anti")
    shown = [row.file_path for row in lost.limit(5).collect()]
    if shown:
        raise MissingFiles(f"{lost.count()} notes without their file, such as {', '.join(map(str, shown))}")


def import_faults(downloads: DataFrame, files: DataFrame, faults: DataFrame | None, run_time: datetime) -> DataFrame:
    """Notes whose file gave no rows, with the columns it lacks if that is the reason.

    `files` is the turnout of the exports. Such a note may come again once the file is mended.
    """
    without = downloads.select("export_url", "file_path").join(files.select("file_path"), "file_path", "left_anti")
    if faults is None:
        marked = without.withColumn("missing", F.lit(None).cast("array<string>"))
    else:
        marked = without.join(faults.select("file_path", "missing"), "file_path", "left")
    reason = F.when(F.size("missing") > 0, F.concat(F.lit("lacks "), F.array_join("missing", ", ")))
    return marked.select(
        "export_url",
        "file_path",
        F.coalesce(reason, F.lit("no rows")).alias("reason"),
        F.lit(run_time).cast("timestamp").alias("create_time"),
    )


def import_plan(downloads: DataFrame, events: DataFrame, as_of: date) -> DataFrame:
    """What to do with each downloaded file.

    skip           the event is imported and over
    full           the event is over: load its scores
    metadata_only  the event still runs: note it, but load no scores yet

    An event known under the URL keeps its id; is_new tells whether its row must be added.
    `downloads` has file_path, export_url, league_id and event_end_date.
    """
    known = events.groupBy("export_url").agg(
        F.min_by(F.struct("event_id", "is_imported"), "event_id").alias("known")
    )
    over = is_finished(F.col("event_end_date"), as_of)
    done = F.coalesce(F.col("known.is_imported"), F.lit(False)) & over
    return (
        downloads.join(known, "export_url", "left")
        .withColumn("event_id", F.coalesce("known.event_id", F.sha2("export_url", 256)))
        .withColumn("is_new", F.col("known").isNull())
        .withColumn("action", F.when(done, "skip").when(over, "full").otherwise("metadata_only"))
        .drop("known")
    )


def turnout(exports: DataFrame) -> DataFrame:
    """One row per export file that has rows; num_players counts the names that are not NULL."""
    return exports.groupBy("file_path").agg(F.count("name").alias("num_players"))


def event_rows(files: DataFrame, plan: DataFrame, run_time: datetime) -> DataFrame:
    """Rows for events not stored yet, from the turnout of their files."""
    stamp = F.lit(run_time).cast("timestamp")
    fixed = {
        "is_downloaded": F.lit(True),
        "is_imported": F.lit(False),
        "import_date": F.lit(None),
        "create_time": stamp,
        "update_time": stamp,
        **{name: F.lit(value) for name, value in CLEARED.items()},
    }
    return (
        plan.where((F.col("action") != "skip") & F.col("is_new"))
        .join(files, "file_path")
        .withColumn("event_name", event_name(F.col("file_path")))
        .withColumn("file_name", F.substring_index("file_path", "/", -1))
        .withColumn("download_date", download_time(F.col("file_path")))
        .withColumns(fixed)
        .select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in EVENTS])
    )


COPIES = 1000  # equal rows that are numbered in one step


def row_content(present: list[str]) -> Column:
    """A text that says what is in all cells of a row; the same whatever other columns there are."""

    def said(name: str) -> Column:
        cell = F.col(name) if name in present else F.lit(None).cast("string")
        return F.coalesce(F.concat(F.length(cell).cast("string"), F.lit(":"), cell), F.lit("-"))

    return F.concat_ws("|", *[said(name) for name in CELLS])


def identified_rows(exports: DataFrame, plan: DataFrame) -> DataFrame:
    """Export rows that name a player, with a round id that every reading of the file gives again.

    The id hashes the export URL, the row's cells and, among equal rows, the number of the copy.
    Equal rows are counted and written out again in bounded steps, so they make no large group.
    """
    cells = [name for name in CELLS if name in exports.columns]
    others = ["file_path", "export_url", "event_id", "league_id"]
    counted = (
        exports.where(to_text(F.col("name")).isNotNull())
        .join(plan.where(F.col("action") == "full").select(*others), "file_path")
        .groupBy(*others, *cells)
        .agg(F.count("*").alias("copies"))
    )
    first = F.sequence(F.lit(1).cast("bigint"), F.col("copies"), F.lit(COPIES).cast("bigint"))
    few = counted.where(F.col("copies") <= COPIES).withColumn("first", F.lit(1).cast("bigint"))
    many = counted.where(F.col("copies") > COPIES).withColumn("first", F.explode(first))
    spread = few.unionByName(many.repartition("file_path", "first", *cells))
    last = F.least(F.col("first") + (COPIES - 1), "copies")
    return (
        spread.withColumn("copy", F.explode(F.sequence("first", last)))
        .withColumn("raw_score_id", F.sha2(F.concat_ws("|", "export_url", "copy", row_content(cells)), 256))
        .select("file_path", "event_id", "league_id", "raw_score_id", *cells)
    )


def _year(rows: DataFrame) -> list[str]:
    """The year of the event, where the rows tell it."""
    return ["year"] if "year" in rows.columns else []


def clean_scores(rows: DataFrame) -> DataFrame:
    """Typed round columns of named export rows."""
    return rows.where(to_text(F.col("name")).isNotNull()).select(
        "raw_score_id",
        "event_id",
        "league_id",
        to_text(F.col("division")).alias("division"),
        to_text(F.col("name")).alias("player_name"),
        to_text(F.col("username")).alias("player_username"),
        to_int(F.col("round_total_score")).alias("raw_score"),
        *_year(rows),
    )


def raw_score_rows(rows: DataFrame, run_time: datetime) -> DataFrame:
    stamp = F.lit(run_time).cast("timestamp")
    return clean_scores(rows).withColumns({"create_time": stamp, "update_time": stamp}).select(*RAW_SCORES.names, *_year(rows))


def hole_unpivot(rows: DataFrame) -> DataFrame:
    """One row per round and played hole; empty, unreadable and zero cells are not scores."""
    holes = [name for name in rows.columns if name in HOLES]
    if not holes:
        return rows.select(
            "raw_score_id", *_year(rows), F.lit(0).cast("bigint").alias("hole_number"), F.lit(0).cast("bigint").alias("hole_score")
        ).limit(0)
    filled = F.filter(
        F.array(*[F.struct(hole_number(F.lit(name)).alias("hole"), F.col(name).alias("cell")) for name in holes]),
        lambda hole: hole["cell"].isNotNull(),
    )
    return (
        rows.select("raw_score_id", *_year(rows), F.inline(filled))
        .select(
            "raw_score_id",
            *_year(rows),
            F.col("hole").alias("hole_number"),
            to_int(F.col("cell")).alias("hole_score"),
        )
        .where(F.col("hole_score") != 0)
    )


def hole_score_rows(rows: DataFrame, run_time: datetime) -> DataFrame:
    stamp = F.lit(run_time).cast("timestamp")
    return (
        hole_unpivot(rows)
        .withColumn("hole_score_id", F.sha2(F.concat_ws("|", "raw_score_id", "hole_number"), 256))
        .withColumns({"create_time": stamp, "update_time": stamp})
        .select(*HOLE_SCORES.names, *_year(rows))
    )
