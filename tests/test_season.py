"""Season reports."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tallyboard import schemas
from tallyboard.plans import season
from tallyboard.plans.adjusted import adjusted_scores
from tallyboard.plans.handicaps import handicaps
from tallyboard.sources.payouts import payout_ladder
from tests.world import NOW, TODAY, World, event, frame, league, random_world, score

SEASON = 2026


def reports(spark, world):
    raw, events, leagues = world.frames(spark)
    strokes = handicaps(raw, events, leagues, TODAY, NOW).cache()
    adjusted = adjusted_scores(raw, strokes, payout_ladder(spark, NOW), events, leagues, 2016).cache()
    calendar = season.season_event_summary(events, adjusted, leagues, SEASON).cache()
    players = season.season_players_summary(adjusted, strokes, SEASON).cache()
    log = season.season_log(players, calendar, leagues, adjusted, SEASON)
    return adjusted, calendar, players, log


def small_world():
    return World(
        [league(league_is_handicap=False)],
        [event("e1", date(2026, 1, 5)), event("e2", date(2026, 1, 12)), event("e3", date(2026, 1, 19)),
         event("e0", date(2025, 12, 31)), event("unplayed", date(2026, 2, 1))],
        [
            score("r1", "e1", "ann", 50), score("r2", "e1", "bob", 52),
            score("r3", "e2", "ann", 51, division="FPO"),
            score("r4", "e3", "bob", 49),
            score("r5", "e0", "cat", 49),
            score("r6", "e2", None, 60, name="Guest"),
        ],
    )


def test_small_season(spark):
    adjusted, calendar, players, log = reports(spark, small_world())
    events = {r.event_id: (r.num_players, r.average_raw_score, r.event_rank_in_league) for r in calendar.collect()}
    assert events == {"e1": (2, 51.0, 3), "e2": (2, 55.5, 2), "e3": (1, 49.0, 1)}

    standing = {(r.player_username, r.division): r for r in players.collect()}
    assert set(standing) == {("ann", "MPO"), ("ann", "FPO"), ("bob", "MPO"), (None, "MPO")}
    bob = standing["bob", "MPO"]
    assert (bob.events_played, bob.season_points, bob.season_place, bob.average_raw_score) == (2, 2, 1, 50.5)
    assert standing["ann", "MPO"].season_place == 1
    assert standing[None, "MPO"].season_place == 3
    assert bob.last_played_date == date(2026, 1, 19)

    rows = log.collect()
    # Four standings at three events each, played or not.
    assert len(rows) == 12
    by = {}
    for r in rows:
        by.setdefault((r.player_username, r.event_id), set()).add((r.division, r.raw_score, r.points, r.season_points_as_of_event))
    assert by["bob", "e1"] == {("MPO", 52, Decimal(1), Decimal(1))}
    assert by["bob", "e2"] == {("MPO", None, None, Decimal(1))}
    assert by["bob", "e3"] == {("MPO", 49, Decimal(1), Decimal(2))}
    assert by["ann", "e2"] == {("FPO", 51, Decimal(1), Decimal(1))}
    assert by["ann", "e3"] == {("FPO", None, None, Decimal(1))}
    assert {v for e in ("e1", "e2", "e3") for v in by[None, e]} == {(None, None, None, Decimal(0))}


def test_log_before_a_players_first_event_is_empty_handed(spark):
    world = small_world()
    world.scores = [s for s in world.scores if s["raw_score_id"] in ("r1", "r4")]
    *_, log = reports(spark, world)
    early = [r for r in log.collect() if (r.player_username, r.event_id) == ("bob", "e1")]
    assert [(r.division, r.season_points_as_of_event, r.handicap) for r in early] == [(None, Decimal(0), 0)]


def test_hole_scores_of_the_season(spark):
    world = small_world()
    adjusted, calendar, *_ = reports(spark, world)
    holes = frame(
        spark,
        [dict(hole_score_id=f"{r}-{h}", raw_score_id=r, hole_number=h, hole_score=3 + h)
         for r in ("r1", "r5", "r6", "gone") for h in (1, 2)],
        schemas.HOLE_SCORES,
    )
    leagues = world.frames(spark)[2]
    rows = season.season_hole_scores(adjusted, calendar, leagues, holes, SEASON).collect()
    assert sorted((r.player_display_name or "", r.hole_number, r.hole_score, r.event_name) for r in rows) == [
        ("", 1, 4, "event e2"), ("", 2, 5, "event e2"),
        ("Ann (ann)", 1, 4, "event e1"), ("Ann (ann)", 2, 5, "event e1"),
    ]


def test_a_filter_of_ids_loses_no_match(spark):
    keys = spark.createDataFrame([(f"r{i}",) for i in range(0, 3000, 3)] + [("r0",), (None,)], "id string")
    rows = spark.createDataFrame([(f"r{i}", i) for i in range(3000)] + [("r0", -1), (None, -2)], "id string, n int")
    kept = {(r.id, r.n) for r in season.likely_in(rows, keys, "id").collect()}
    assert kept >= {(f"r{i}", i) for i in range(0, 3000, 3)} | {("r0", -1)}
    assert len(kept) < 1100
    assert season.likely_in(rows, keys.limit(0), "id").count() == 0


def test_holes_of_other_rounds_are_not_shuffled(spark):
    """With every join shuffled, the holes meet the filter below the shuffle by round."""
    world = small_world()
    adjusted, calendar, *_ = reports(spark, world)
    holes = frame(spark, [dict(hole_score_id="h", raw_score_id="r1", hole_number=1, hole_score=3)], schemas.HOLE_SCORES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = season.season_hole_scores(adjusted, calendar, world.frames(spark)[2], holes, SEASON)
        lines = table._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffled = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(raw_score_id" in line]
    assert shuffled
    assert any("getbit" in line for line in lines[shuffled[0]:shuffled[1]])


def test_random_seasons_add_up(spark):
    adjusted, calendar, players, log = reports(spark, random_world(11, rounds=300))
    in_season = adjusted.where(F.year("event_end_date") == SEASON).cache()
    assert calendar.agg(F.sum("num_players")).first()[0] == in_season.count()
    assert players.agg(F.sum("events_played")).first()[0] == in_season.count()
    assert players.agg(F.sum("season_points")).first()[0] == in_season.agg(F.sum("points")).first()[0]
    # Every standing meets every event of its league, once per round the player had there.
    expected = (
        players.select("player_username", "league_id")
        .join(calendar.select("league_id", "event_id"), "league_id")
        .join(in_season.select("event_id", "player_username", "raw_score_id"), ["event_id", "player_username"], "left")
        .count()
    )
    rows = log.collect()
    assert len(rows) == expected
    for r in rows:
        if r.raw_score is not None and r.player_username is not None:
            assert r.season_points_as_of_event >= r.points


def test_shares_follow_the_size_of_a_league(spark, monkeypatch):
    monkeypatch.setattr(season, "PLAYERS_PER_SHARE", 10)
    players = spark.createDataFrame([("small",)] * 10 + [("middle",)] * 25 + [("large",)] * 900, "league_id string")
    shares = {r.league_id: r.shares for r in season.league_shares(players, 16).collect()}
    assert shares == {"small": 1, "middle": 3, "large": 16}
