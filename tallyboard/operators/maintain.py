"""Row-level upkeep of the stored tables, as new versions of the whole table.

Plain Parquet has no UPDATE or DELETE, so every change takes the old rows and returns the
new ones; the caller writes them to a fresh place.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.schemas import EVENTS

OVERRIDES = [
    "is_excluded_from_handicap",
    "is_no_handicap_applied",
    "is_excluded_from_points",
    "points_multiplier",
    "buy_in_override_ammt",
]
# What an event carries before its overrides are applied.
CLEARED = {
    "is_excluded_from_handicap": False,
    "is_no_handicap_applied": False,
    "is_excluded_from_points": False,
    "points_multiplier": None,
    "buy_in_override_ammt": None,
}


def _matched(table: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The table next to its changes (as `new`, NULL where there is none).

    Two changes for one row are an error, as in a warehouse UPDATE. The check sits in a
    filter so that column pruning cannot remove it.
    """
    one_change = changes.groupBy(F.col(key).alias("_key")).agg(
        F.count("*").alias("_copies"), F.first(F.struct(*columns)).alias("new")
    )
    clash = F.raise_error(F.concat(F.lit(f"more than one change for {key} "), F.col("_key")))
    return table.join(one_change, F.col(key) == F.col("_key"), "left").where(
        F.when(F.col("_copies") > 1, clash.cast("boolean")).otherwise(F.lit(True))
    )


def _touched(run_time: datetime):
    return F.when(F.col("new").isNotNull(), F.lit(run_time).cast("timestamp")).otherwise(F.col("update_time"))


def reset_overrides(events: DataFrame) -> DataFrame:
    return events.withColumns({name: F.lit(value).cast(EVENTS[name].dataType) for name, value in CLEARED.items()})


def apply_event_updates(events: DataFrame, updates: DataFrame, run_time: datetime) -> DataFrame:
    """Clear all overrides, then set those listed for an event's export URL; NULL sets nothing."""
    matched = _matched(reset_overrides(events), updates, "export_url", OVERRIDES)
    changed = {name: F.coalesce(F.col(f"new.{name}"), F.col(name)) for name in OVERRIDES}
    return matched.withColumns({**changed, "update_time": _touched(run_time)}).select(*events.columns)


def mark_imported(events: DataFrame, event_ids: DataFrame, run_time: datetime) -> DataFrame:
    """Flag the listed events as imported; an id may be listed more than once."""
    listed = event_ids.select(F.col("event_id").alias("_key")).distinct()
    found = F.col("_key").isNotNull()
    return events.join(listed, F.col("event_id") == F.col("_key"), "left").withColumns(
        {
            "is_imported": F.when(found, F.lit(True)).otherwise(F.col("is_imported")),
            "update_time": F.when(found, F.lit(run_time).cast("timestamp")).otherwise(F.col("update_time")),
        }
    ).select(*events.columns)


def overwrite_matched(
    table: DataFrame, changes: DataFrame, key: str, columns: list[str], run_time: datetime
) -> DataFrame:
    """Replace the given columns of every listed row, also with NULL."""
    found = F.col("new").isNotNull()
    replaced = {name: F.when(found, F.col(f"new.{name}")).otherwise(F.col(name)) for name in columns}
    return (
        _matched(table, changes, key, columns)
        .withColumns({**replaced, "update_time": _touched(run_time)})
        .select(*table.columns)
    )


def update_file_metadata(events: DataFrame, files: DataFrame, run_time: datetime) -> DataFrame:
    return overwrite_matched(events, files, "event_id", ["file_name", "file_path"], run_time)


def update_leagues(leagues: DataFrame, changes: DataFrame, run_time: datetime) -> DataFrame:
    editable = [c for c in leagues.columns if c not in ("league_id", "create_time", "update_time")]
    return overwrite_matched(leagues, changes, "league_id", editable, run_time)


def prune_raw_scores(raw_scores: DataFrame, events: DataFrame) -> DataFrame:
    """Rounds whose event exists."""
    return raw_scores.join(events.select("event_id"), "event_id", "left_semi").select(*raw_scores.columns)


def prune_hole_scores(hole_scores: DataFrame, raw_scores: DataFrame) -> DataFrame:
    """Hole scores whose round exists; pass the pruned rounds so that removal cascades."""
    return hole_scores.join(raw_scores.select("raw_score_id"), "raw_score_id", "left_semi").select(
        *hole_scores.columns
    )


def orphan_raw_scores(raw_scores: DataFrame, events: DataFrame) -> DataFrame:
    return raw_scores.join(events.select("event_id"), "event_id", "left_anti")


def orphan_hole_scores(hole_scores: DataFrame, raw_scores: DataFrame) -> DataFrame:
    return hole_scores.join(raw_scores.select("raw_score_id"), "raw_score_id", "left_anti")


def schema_drift(found: T.StructType, declared: T.StructType) -> dict[str, list[str]]:
    """Columns that are missing, unknown or of another type than declared."""
    have = {field.name: field.dataType for field in found}
    want = {field.name: field.dataType for field in declared}
    return {
        "missing": sorted(want.keys() - have.keys()),
        "unknown": sorted(have.keys() - want.keys()),
        "retyped": sorted(name for name in want.keys() & have.keys() if want[name] != have[name]),
    }


def conform(table: DataFrame, declared: T.StructType, extra: Column | None = None) -> DataFrame:
    """The table in its declared layout: no row is lost, values that do not fit become NULL.

    `extra` is a further column to keep.
    """
    have = {field.name: field.dataType for field in table.schema}

    def fitted(field):
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if have[field.name] == field.dataType:
            return F.col(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return table.select(*[fitted(field) for field in declared], *([] if extra is None else [extra]))


def misfit_cells(table: DataFrame, declared: T.StructType) -> DataFrame:
    """The cells that `conform` cannot keep: (row_id, column, reason, value), one row each.

    Values of columns that the layout does not know, and values that its types cannot hold. `row_id` is the first
    declared column, NULL if the table has none of that name.
    """
    drift = schema_drift(table.schema, declared)
    cells = []
    for name in [*drift["unknown"], *drift["retyped"]]:
        value = F.col(f"`{name}`")
        lost, reason = value.isNotNull(), "unknown column"
        if name in drift["retyped"]:
            kind = declared[name].dataType
            lost, reason = lost & value.try_cast(kind).isNull(), f"no {kind.simpleString()}"
        cell = F.struct(F.lit(name).alias("column"), F.lit(reason).alias("reason"), value.cast("string").alias("value"))
        cells.append(F.when(lost, cell))
    first = declared.fieldNames()[0]
    row_id = (F.col(f"`{first}`") if first in table.columns else F.lit(None)).cast("string").alias("row_id")
    if not cells:
        return table.select(row_id, *[F.lit(None).cast("string").alias(c) for c in ("column", "reason", "value")]).limit(0)
    found = table.select(row_id, F.explode(F.filter(F.array(*cells), lambda cell: cell.isNotNull())).alias("cell"))
    return found.select("row_id", "cell.*")
