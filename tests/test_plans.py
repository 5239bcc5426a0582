"""What the physical plans look like, and results when one key holds most rows."""

import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from checks.registry import Tables, queries, still_there
from tallyboard.operators.handicap import league_rounds, player_days
from tallyboard.plans.adjusted import adjusted_scores
from tallyboard.plans.handicaps import handicaps
from tallyboard.sources.payouts import payout_ladder
from tallyboard.sources.tables import write_staged
from tests.world import NOW, TODAY, World, event, league, random_world, score, slow_adjusted, slow_handicaps

FOLDER = "/root/testdata/sf0.001"
HEAVY = ["handicaps", "adjusted_scores", "season_players_summary", "season_log", "season_hole_scores", "payout_shares"]


def plan_text(table):
    return table._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HEAVY)
def test_no_nested_loops_and_no_python_in_plans(spark, name):
    plan = plan_text(queries()[name](spark, FOLDER))
    for bad in ("NestedLoop", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in plan
    # Every window has partitions.
    assert not re.search(r"windowspecdefinition\((specifiedwindowframe|\w+#\d+L? (ASC|DESC))", plan)


def test_season_reports_read_one_year_and_few_columns(spark):
    t = Tables(spark, FOLDER)
    plan = plan_text(t.season_players)
    scans = [line for line in plan.splitlines() if "FileScan" in line and "points#" in line]
    assert scans and all("PartitionFilters: [isnotnull(year" in line for line in scans)
    assert all("raw_score_id" not in line for line in scans)


def test_windows_see_days_and_scores_not_rounds(spark):
    """The windows over players and fields run above an aggregate."""
    t = Tables(spark, FOLDER)
    for plan, keys in (
        (plan_text(player_days(t.rounds)), r"\[league_id#\d+, player_username#\d+\], \["),
        (plan_text(t.places), r"\[league_id#\d+, division#\d+, event_id#\d+\], \["),
    ):
        lines = plan.splitlines()
        windows = [i for i, line in enumerate(lines) if "Window [" in line and re.search(keys, line)]
        assert windows
        for i in windows:
            following = [re.search(r"\b(\w*Aggregate|FileScan)\b", line) for line in lines[i:]]
            assert next(m.group(1) for m in following if m) != "FileScan"


def test_rounds_get_results_without_a_shuffle_by_score(spark):
    """The results of distinct scores are written first, so Spark knows that they are small."""
    raw, events, leagues = crowded_world().frames(spark)
    strokes = handicaps(raw, events, leagues, TODAY, NOW)
    plan = plan_text(adjusted_scores(raw, strokes, payout_ladder(spark, NOW), events, leagues, 2025))
    assert "scored_rounds" in plan and "score_results" in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "adjusted_score#" in line]


def test_events_and_overrides_come_from_written_events(spark):
    assert "orders.parquet" not in plan_text(Tables(spark, FOLDER).events)


def crowded_world():
    """One event, one shared name and one score hold most of the rounds."""
    world = random_world(5, rounds=120)
    busy = event("A-busy", date(2026, 2, 2), "A")
    events = [*world.events, busy, *[event(f"A-w{i}", date(2026, 3, 1) + timedelta(weeks=i), "A") for i in range(8)]]
    crowd = [score(f"x{i:04d}", "A-busy", "guest" if i % 2 else None, 50 if i % 3 else 47 + i % 9, "A") for i in range(300)]
    crowd += [score(f"y{i:04d}", f"A-w{i % 8}", "guest", 48 + i % 11, "A") for i in range(200)]
    return World(world.leagues, events, [*world.scores, *crowd])


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_crowded_keys_keep_results_whole(spark, broadcast):
    """Also with every join shuffled and every larger partition taken for skewed."""
    world = crowded_world()
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": broadcast,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": broadcast,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        raw, events, leagues = world.frames(spark)
        raw = raw.repartition(5)
        strokes = handicaps(raw, events, leagues, TODAY, NOW)
        mine = adjusted_scores(raw, strokes, payout_ladder(spark, NOW), events, leagues, 2025)
        got = {
            r.raw_score_id: (r.adjusted_score, r.place, r.points, r.payout, r.season_points_as_of_event)
            for r in mine.collect()
        }
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    handicap_of = {k: v[2] for k, v in slow_handicaps(world, TODAY).items()}
    assert got == slow_adjusted(world, handicap_of, 2025)


def test_history_groups_are_days(spark):
    """Three hundred rounds of one name on one day become one row of history."""
    days = player_days(league_rounds(*crowded_world().frames(spark), TODAY)).where("player_username = 'guest'")
    sizes = days.groupBy("league_id", "player_username").count().collect()
    assert [r["count"] for r in sizes] == [9]
    assert days.agg(F.max(F.size("considered"))).first()[0] == 3


def test_written_tables_are_reused_while_their_files_last(spark, tmp_path):
    first = Tables(spark, FOLDER).stored("leagues")
    assert Tables(spark, FOLDER).stored("leagues") is first
    assert Tables(spark, FOLDER, fresh=True).stored("leagues") is not first
    table = spark.range(10).withColumn("year", F.col("id") % 2).repartition(1)
    folder = write_staged(table, "probe", "year")
    assert still_there(table, folder, 2)
    assert not still_there(table, folder, 3)
    assert not still_there(table, folder + "-gone", 2)
