"""Overrides, metadata, pruning, lookups and schema upkeep."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard import schemas
from tallyboard.operators import lookups, maintain
from tallyboard.plans.pipeline import Run, inspect, prune
from tallyboard.schemas import EVENTS, HOLE_SCORES, RAW_SCORES
from tallyboard.sources.tables import Store
from tests.world import NOW, event, frame, league, score

OLD = datetime(2020, 1, 1)


def stored_events(spark):
    rows = [
        event("a", date(2026, 5, 1), update_time=OLD, is_excluded_from_points=True, points_multiplier=Decimal(3)),
        event("b", date(2026, 5, 31), update_time=OLD, is_imported=False),
        event("c", date(2026, 6, 1), update_time=OLD, is_imported=None),
        event("d", None, update_time=OLD, export_url=None),
    ]
    return frame(spark, rows, schemas.EVENTS)


def override(event_id, **terms):
    return {"export_url": f"https://example.org/events/{event_id}/leaderboard/export", **terms}


def by_id(table):
    return {r.event_id: r for r in table.collect()}


def test_overrides_are_cleared_and_set(spark):
    updates = frame(
        spark,
        [override("b", is_excluded_from_handicap=True, points_multiplier=Decimal(2)), override("none"),
         override("none"), {"export_url": None, "is_no_handicap_applied": True}],
        schemas.EVENT_UPDATES,
    )
    once = maintain.apply_event_updates(stored_events(spark), updates, NOW)
    assert [(f.name, f.dataType) for f in once.schema] == [(f.name, f.dataType) for f in schemas.EVENTS]
    rows = by_id(once)
    assert (rows["a"].is_excluded_from_points, rows["a"].points_multiplier, rows["a"].update_time) == (False, None, OLD)
    b = rows["b"]
    assert (b.is_excluded_from_handicap, b.points_multiplier, b.buy_in_override_ammt, b.update_time) == (
        True, Decimal(2), None, NOW,
    )
    assert rows["d"].is_no_handicap_applied is False
    assert by_id(maintain.apply_event_updates(once, updates, NOW)) == rows


def test_two_overrides_for_one_event_are_an_error(spark):
    updates = frame(spark, [override("b"), override("b", points_multiplier=Decimal(2))], schemas.EVENT_UPDATES)
    changed = maintain.apply_event_updates(stored_events(spark), updates, NOW).select("event_id")
    with pytest.raises(Exception, match="more than one change for export_url"):
        changed.collect()


def test_mark_imported(spark):
    ids = spark.createDataFrame([("b",), ("b",), ("x",)], "event_id string")
    rows = by_id(maintain.mark_imported(stored_events(spark), ids, NOW))
    assert {k: (r.is_imported, r.update_time) for k, r in rows.items()} == {
        "a": (True, OLD), "b": (True, NOW), "c": (None, OLD), "d": (True, OLD),
    }


def test_file_metadata_may_become_null(spark):
    files = spark.createDataFrame([("a", "new.csv", None)], "event_id string, file_name string, file_path string")
    events = stored_events(spark).selectExpr("* except (file_path)", "'/old' as file_path").select(*schemas.EVENTS.names)
    rows = by_id(maintain.update_file_metadata(events, files, NOW))
    assert (rows["a"].file_name, rows["a"].file_path, rows["a"].update_time) == ("new.csv", None, NOW)
    assert (rows["b"].file_name, rows["b"].file_path, rows["b"].update_time) == (None, "/old", OLD)


def test_update_leagues(spark):
    leagues = frame(spark, [league("A", create_time=OLD, update_time=OLD), league("B", update_time=OLD)], schemas.LEAGUES)
    change = frame(spark, [league("A", league_name="new", handicap_base_score=None, create_time=NOW)], schemas.LEAGUES)
    rows = {r.league_id: r for r in maintain.update_leagues(leagues, change, NOW).collect()}
    a = rows["A"]
    assert (a.league_name, a.handicap_base_score, a.create_time, a.update_time) == ("new", None, OLD, NOW)
    assert (rows["B"].league_name, rows["B"].update_time) == ("B league", OLD)


def test_pruning_cascades_and_is_stable(spark):
    events = stored_events(spark)
    raw = frame(
        spark, [score("1", "a", "x", 5), score("2", "gone", "x", 5), score("3", None, "x", 5)], schemas.RAW_SCORES
    )
    holes = frame(
        spark, [dict(raw_score_id=r, hole_number=1, hole_score=3) for r in ("1", "2", "3", "4", None)],
        schemas.HOLE_SCORES,
    )
    kept = maintain.prune_raw_scores(raw, events)
    assert [r.raw_score_id for r in kept.collect()] == ["1"]
    assert kept.schema == schemas.RAW_SCORES
    kept_holes = maintain.prune_hole_scores(holes, kept)
    assert [r.raw_score_id for r in kept_holes.collect()] == ["1"]
    assert maintain.orphan_raw_scores(raw, events).count() == 2
    assert maintain.orphan_hole_scores(holes, kept).count() == 4
    assert maintain.orphan_raw_scores(kept, events).count() == 0


def test_conform_keeps_every_row(spark):
    found = spark.createDataFrame([("e1", "12", "x"), ("e2", "oops", "y")], "event_id string, num_players string, extra string")
    drift = maintain.schema_drift(found.schema, schemas.EVENTS)
    assert drift["unknown"] == ["extra"] and drift["retyped"] == ["num_players"]
    assert set(drift["missing"]) == set(schemas.EVENTS.names) - {"event_id", "num_players"}
    fixed = maintain.conform(found, schemas.EVENTS)
    assert [(f.name, f.dataType) for f in fixed.schema] == [(f.name, f.dataType) for f in schemas.EVENTS]
    assert {r.event_id: r.num_players for r in fixed.collect()} == {"e1": 12, "e2": None}
    same = T.StructType(list(reversed(schemas.EVENTS.fields)))
    assert maintain.schema_drift(same, schemas.EVENTS) == {"missing": [], "unknown": [], "retyped": []}


def test_lookups(spark):
    events = stored_events(spark)
    urls = [r.export_url for r in lookups.imported_event_urls(events).collect()]
    assert sorted(u or "" for u in urls) == ["", "https://example.org/events/a/leaderboard/export"]
    assert lookups.imported_event_urls(events, "other").count() == 0
    found = lookups.event_by_url(events, "https://example.org/events/b/leaderboard/export").collect()
    assert [(r.event_id, r.is_imported) for r in found] == [("b", False)]
    assert lookups.event_by_url(events, "nowhere").count() == 0

    over = events.where(lookups.is_finished(events["event_end_date"], date(2026, 6, 1)))
    assert sorted(r.event_id for r in over.collect()) == ["a", "b", "d"]

    candidates = spark.createDataFrame(
        [("https://example.org/events/a/leaderboard/export",), ("https://example.org/events/b/leaderboard/export",),
         ("https://example.org/events/b/leaderboard",), (None,)], "export_url string",
    )
    pending = [r.export_url for r in lookups.pending_exports(candidates, events).collect()]
    assert pending == ["https://example.org/events/b/leaderboard/export"]

    leagues = frame(spark, [league("A", league_urls=" u1 | u2 ||"), league("B", league_urls=None)], schemas.LEAGUES)
    assert [r.url for r in lookups.league_urls(leagues, "A").collect()] == ["u1", "u2"]
    assert lookups.league_urls(leagues, "B").count() == lookups.league_urls(leagues, "Z").count() == 0
    a = lookups.league_by_id(leagues, "A").first()
    assert (a.name, a.url, a.urls, a.entry_fee) == ("A league", "u1", ["u1", "u2"], Decimal(4))
    assert lookups.league_by_id(leagues, "B").first().url == ""


def test_older_layouts_are_read_in_the_declared_one(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    new = frame(spark, [score("1", "a", "x", 5)], schemas.RAW_SCORES)
    old = spark.createDataFrame([("2", "a", "6"), ("3", "b", "?")], "raw_score_id string, event_id string, raw_score string")
    folders = [store.write(new, "raw_scores", "r1"), store.write(old, "raw_scores", "r0")]
    store.commit(1, "r1", NOW, {"raw_scores": folders})
    table = store.read("raw_scores")
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in schemas.RAW_SCORES]
    assert sorted((r.raw_score_id, r.raw_score) for r in table.collect()) == [("1", 5), ("2", 6), ("3", None)]
    located = store.read("raw_scores", located=True).collect()
    assert {r.raw_score_id: r.folder[:6] for r in located} == {"1": "run-r1", "2": "run-r0", "3": "run-r0"}
    assert store.read("events").count() == 0
    with pytest.raises(LookupError):
        store.read("season_log")


def test_misfits_are_noted_once_and_prunes_keep_layouts(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run = Run(store, "a", NOW)
    older = spark.createDataFrame(
        [("r1", "e1", "55", "x", [1]), ("r2", "gone", "fifty", None, None), ("r3", "e1", "n/a", "y", [2, 3]), ("r4", "e1", None, None, None)],
        "raw_score_id string, event_id string, raw_score string, note string, extra array<int>",
    )
    run.append("raw_scores", older)
    run.append("raw_scores", spark.createDataFrame([("r9", "e1")], "raw_score_id string, event_id string").select(
        *[F.col(f.name) if f.name in ("raw_score_id", "event_id") else F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_SCORES]
    ))
    run.append("hole_scores", spark.createDataFrame([], HOLE_SCORES))
    run.replace("events", spark.createDataFrame([("e1",)], "event_id string").select(
        *[F.col(f.name) if f.name == "event_id" else F.lit(None).cast(f.dataType).alias(f.name) for f in EVENTS]
    ))
    inspect(run)
    cells = spark.read.parquet(*run.folders["misfits"]).select("table_name", "row_id", "column", "reason", "value")
    expected = [
        ("raw_scores", "r1", "extra", "unknown column", "[1]"),
        ("raw_scores", "r1", "note", "unknown column", "x"),
        ("raw_scores", "r2", "raw_score", "no bigint", "fifty"),
        ("raw_scores", "r3", "extra", "unknown column", "[2, 3]"),
        ("raw_scores", "r3", "note", "unknown column", "y"),
        ("raw_scores", "r3", "raw_score", "no bigint", "n/a"),
    ]
    assert sorted(tuple(r) for r in cells.collect()) == expected
    drift = spark.read.parquet(*run.folders["schema_drift"]).collect()
    assert [(r.table_name, r.unknown, r.retyped) for r in drift] == [("raw_scores", ["extra", "note"], ["raw_score"])]
    assert "division" in drift[0].missing

    prune(run)
    assert run.pruned == {"raw_scores": 1, "hole_scores": 0}
    whole = [spark.read.parquet(folder) for folder in run.folders["raw_scores"]]
    kept = next(table for table in whole if "note" in table.columns)
    assert kept.schema == older.schema
    assert sorted(kept.collect()) == sorted(r for r in older.collect() if r.raw_score_id != "r2")
    inspect(run)
    assert len(run.folders["misfits"]) == 1
    assert sorted(r.raw_score_id for r in run.table("raw_scores").collect()) == ["r1", "r3", "r4", "r9"]


def test_a_year_opens_its_own_folders_only(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run = Run(store, "a", NOW)
    holes = [(f"h{i}", f"r{i % 9}", i % 3, 4, NOW, NOW, 2020 + i % 3) for i in range(30)]
    table = spark.createDataFrame(holes, T.StructType([*HOLE_SCORES, T.StructField("year", T.IntegerType())]))
    run.append("hole_scores", table.where("hole_score_id = 'h0'").drop("year"))  # from before years were kept apart
    run.append_by_year("hole_scores", table.where("hole_score_id <> 'h0' and year < 2022"))
    run.append_by_year("hole_scores", table.where("year = 2022"))
    run.append_by_year("hole_scores", table.where("year = 1900"))
    assert len(run.folders["hole_scores"]) == 4
    assert run.table("hole_scores").schema == HOLE_SCORES
    assert run.table("hole_scores").count() == 30
    one = run.table("hole_scores", 2021)
    assert sorted(r.hole_score_id for r in one.collect()) == sorted(["h0", *[h[0] for h in holes if h[-1] == 2021]])
    assert not [file for file in one.inputFiles() if "year=2020" in file or "year=2022" in file]

    # A prune rewrites the folders of a year as folders of that year.
    kept = spark.createDataFrame([(f"r{i}", "e") for i in range(9) if i != 1], "raw_score_id string, event_id string")
    run.append("raw_scores", kept.select(*[F.col(f.name) if f.name in kept.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_SCORES]))
    run.replace("events", spark.createDataFrame([("e",)], "event_id string").select(
        *[F.col(f.name) if f.name == "event_id" else F.lit(None).cast(f.dataType).alias(f.name) for f in EVENTS]
    ))
    prune(run)
    assert run.pruned["hole_scores"] == len([h for h in holes if h[1] == "r1"])
    left = [h[0] for h in holes if h[1] != "r1"]
    assert sorted(r.hole_score_id for r in run.table("hole_scores").collect()) == sorted(left)
    assert sorted(r.hole_score_id for r in run.table("hole_scores", 2021).collect()) == sorted(
        {"h0", *[h[0] for h in holes if h[-1] == 2021 and h[1] != "r1"]}
    )


def test_orphans_are_found_by_marks_of_files(spark, tmp_path):
    store = Store(spark, str(tmp_path / "a b+c"))
    run = Run(store, "a", NOW)
    holes = [(f"h{i}", None if i == 7 else f"r{i % 4}", i % 3, 4, NOW, NOW, 2020 + i % 3) for i in range(12)]
    table = spark.createDataFrame(holes, T.StructType([*HOLE_SCORES, T.StructField("year", T.IntegerType())]))
    run.append_by_year("hole_scores", table)
    run.append("hole_scores", table.where("raw_score_id = 'r1'").drop("year"))
    folders = run.folders["hole_scores"]
    marked = store.read("hole_scores", folders, marked=True)
    # No text is worked out for a row; a mark leads to the folder that `located` tells.
    assert "regexp" not in marked._jdf.queryExecution().optimizedPlan().toString()
    told = store.read("hole_scores", folders, located=True).select("hole_score_id", "folder").collect()
    found = marked.join(store.places(folders), "place").select("hole_score_id", "folder").collect()
    assert len({r.folder for r in told}) == 4
    assert sorted(found) == sorted(told)
