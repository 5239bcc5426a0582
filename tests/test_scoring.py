"""Handicaps, places, points and prize money against row-by-row results and worked cases."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyboard import schemas
from tallyboard.operators import placing
from tallyboard.operators.handicap import considered_rounds, league_rounds, player_days, receiving_rounds
from tallyboard.operators.ranking import running_totals, with_rank, with_running_total
from tallyboard.plans.adjusted import adjusted_scores
from tallyboard.plans.handicaps import handicaps
from tallyboard.sources.payouts import field_ladders, payout_ladder, pot_share
from tests.world import NOW, TODAY, World, event, frame, league, random_world, score, slow_adjusted, slow_handicaps


def handicap_rows(spark, world, today=TODAY):
    rows = handicaps(*world.frames(spark), today, NOW).collect()
    found = {
        r.raw_score_id: (
            r.next_handicap, r.next_raw_scores_considered, r.handicap, r.raw_scores_considered, r.handicap_rank,
        )
        for r in rows
    }
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("seed", range(4))
def test_handicaps_equal_the_row_by_row_result(spark, seed):
    world = random_world(seed)
    expected = slow_handicaps(world, TODAY)
    assert len(expected) > 20
    assert handicap_rows(spark, world) == expected


@pytest.mark.parametrize("seed", range(3))
def test_adjusted_scores_equal_the_row_by_row_result(spark, seed):
    world = random_world(seed, rounds=260)
    raw, events, leagues = world.frames(spark)
    strokes = handicaps(raw, events, leagues, TODAY, NOW)
    got = adjusted_scores(raw, strokes, payout_ladder(spark, NOW), events, leagues, 2025).collect()
    expected = slow_adjusted(world, {k: v[2] for k, v in slow_handicaps(world, TODAY).items()}, 2025)
    assert {
        r.raw_score_id: (r.adjusted_score, r.place, r.points, r.payout, r.season_points_as_of_event) for r in got
    } == expected
    assert len(got) == len(expected)


def series(*raw_scores, first=date(2026, 1, 1), **terms):
    """One player, one event a week."""
    events = [event(f"e{i}", first + timedelta(weeks=i)) for i in range(len(raw_scores))]
    return World(
        [league(**terms)], events, [score(f"r{i}", f"e{i}", "ann", raw) for i, raw in enumerate(raw_scores)]
    )


def test_a_worked_handicap(spark):
    # Too few rounds until the third event; then 0.8 x (mean of the last three - 49), rounded.
    found = handicap_rows(spark, series(55, 56, 57, 60))
    assert found["r0"] == (0, "55", None, None, 4)
    assert found["r1"] == (0, "56,55", 0, "55", 3)
    assert found["r2"] == (6, "57,56,55", 0, "56,55", 2)
    assert found["r3"] == (7, "60,57,56", 6, "57,56,55", 1)


def test_scores_below_the_base_give_no_negative_handicap(spark):
    assert handicap_rows(spark, series(40, 40, 40))["r2"][0] == 0


def test_missing_scores_neither_count_nor_break_the_chain(spark):
    found = handicap_rows(spark, series(None, 60, None, handicap_minimum_rounds=1, handicap_rounds_considered=1))
    assert found["r0"] == (None, None, None, None, 3)
    assert found["r1"] == (9, "60", None, None, 2)
    assert found["r2"] == (None, None, 9, "60", 1)


def test_rounds_before_the_lookback_are_gone(spark):
    world = series(55, 56, first=date(2024, 12, 28))
    assert set(handicap_rows(spark, world)) == {"r1"}
    assert handicap_rows(spark, world, date(2027, 1, 1)) == {}


def test_excluded_and_handicap_free_events(spark):
    world = series(55, 70, 57, 58, handicap_minimum_rounds=1)
    world.events[1]["is_excluded_from_handicap"] = True
    world.events[2]["is_no_handicap_applied"] = True
    found = handicap_rows(spark, world)
    assert set(found) == {"r0", "r1", "r3"}
    assert found["r1"][1] == "55"
    assert found["r3"][:3] == (6, "58,57,55", 5)


def test_intermediate_steps(spark):
    rounds = league_rounds(*series(55, 56, 57, 60).frames(spark), TODAY)
    counts = receiving_rounds(rounds, player_days(rounds)).select("raw_score_id", "earlier_rounds").collect()
    assert dict(map(tuple, counts)) == {"r0": 0, "r1": 1, "r2": 2, "r3": 3}
    used = considered_rounds(rounds).where("raw_score_id = 'r3'").orderBy("recency").collect()
    assert [r.used_raw_score for r in used] == [60, 57, 56]


def test_ladder(spark):
    rows = payout_ladder(spark, NOW).collect()
    assert len(rows) == 1717
    by_size = {}
    for r in rows:
        by_size.setdefault(r.n_players, {})[r.position] = r
    for size, rungs in by_size.items():
        winners = -(-size // 3)
        weights = [0.64**i for i in range(winners)]
        assert sorted(rungs) == list(range(1, winners + 1))
        for position, weight in enumerate(weights, start=1):
            share = weight / sum(weights)
            assert float(rungs[position].weight) == round(weight, 9)
            assert float(rungs[position].percentage) == round(share, 9)
            assert float(rungs[position].payout_percent) == round(share * 100, 4)


def one_event(spark, raws, **terms):
    world = World(
        [league(league_is_handicap=False)],
        [event("e", date(2026, 5, 1), **terms)],
        [score(f"r{i:03d}", "e", f"p{i}", raw) for i, raw in enumerate(raws)],
    )
    raw, events, leagues = world.frames(spark)
    none = handicaps(raw, events, leagues, TODAY, NOW)
    rows = adjusted_scores(raw, none, payout_ladder(spark, NOW), events, leagues).orderBy("raw_score_id").collect()
    return [(r.place, int(r.points), int(r.payout)) for r in rows]


def test_worked_prize_money(spark):
    # Six players at 4.00 less 10 % make a pot of 21.6, split 0.609756098 to 0.390243902.
    assert one_event(spark, [50, 51, 52, 53, 54, 55]) == [
        (1, 6, 13), (2, 5, 8), (3, 4, 0), (4, 3, 0), (5, 2, 0), (6, 1, 0),
    ]
    # Two winners share both places; of three on second place only one place is paid.
    assert one_event(spark, [50, 50, 52, 53, 54, 55])[:3] == [(1, 6, 11), (1, 6, 11), (3, 4, 0)]
    assert one_event(spark, [50, 51, 51, 51, 54, 55])[:4] == [(1, 6, 13), (2, 5, 3), (2, 5, 3), (2, 5, 3)]


def test_a_missing_score_ranks_first(spark):
    assert one_event(spark, [None, 50, 51])[0] == (1, 3, 11)


def test_points_rules(spark):
    assert one_event(spark, [50, 51], is_excluded_from_points=True) == [(1, 0, 7), (2, 0, 0)]
    assert one_event(spark, [50, 51], is_excluded_from_points=None, points_multiplier=Decimal(2))[0][1] == 4


def test_fields_beyond_the_ladder_pay_nothing(spark):
    assert {payout for _, _, payout in one_event(spark, list(range(101)))} == {0}
    assert sum(payout for _, _, payout in one_event(spark, list(range(100)))) > 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(45, 52), min_size=1, max_size=40))
def test_shares_of_a_field_never_exceed_the_pot(spark, raws):
    rows = [score(f"r{i}", "e", f"p{i}", raw) for i, raw in enumerate(raws)]
    scored = frame(spark, rows, schemas.RAW_SCORES).withColumn("adjusted_score", F.col("raw_score"))
    shares = placing.with_pot_share(placing.score_places(scored), payout_ladder(spark, NOW)).collect()
    total = sum(r.split_percentage * r.tie_count for r in shares)
    assert 1 - Decimal("1e-7") < total < 1 + Decimal("1e-7")
    for r in shares:
        better = sum(raw < r.adjusted_score for raw in raws)
        assert (r.place, r.tie_count, r.num_players) == (better + 1, raws.count(r.adjusted_score), len(raws))


def test_null_groups_rank_and_total_like_any_other(spark):
    rows = [(None, 1, 5), (None, 1, 7), (None, 2, 5), ("x", 1, 1), ("x", None, 2)]
    table = spark.createDataFrame(rows, "grp string, day int, amount int")
    ranked = with_rank(table, ["grp"], "amount", "place", descending=True)
    assert sorted((r.amount, r.place) for r in ranked.collect() if r.grp is None) == [(5, 2), (5, 2), (7, 1)]
    totals = with_running_total(table, ["grp"], "day", "amount", "total").collect()
    assert sorted((r.day, r.amount, r.total) for r in totals if r.grp is None) == [(1, 5, 12), (1, 7, 12), (2, 5, 17)]
    assert sorted((r.day or 0, r.total) for r in totals if r.grp == "x") == [(0, 2), (1, 3)]


def test_shares_of_any_field_are_those_of_the_ladder(spark):
    """The closed sums agree with the rungs for all places and ties of small fields, and go on beyond the ladder."""
    cases = [(p, t, n) for n in [*range(1, 40), 99, 100, 101, 1000, 10**6] for p in (1, 2, 3, 7, n) for t in (1, 2, 5) if p + t - 1 <= n]
    rows = spark.createDataFrame(cases, "place long, ties long, n long")
    got = rows.select(
        "*",
        pot_share(F.col("place"), F.col("ties"), F.col("n")).alias("limited"),
        pot_share(F.col("place"), F.col("ties"), F.col("n"), None).alias("any"),
    ).collect()
    for r in got:
        weights = [0.64**i for i in range(min(-(-r.n // 3), 200))]
        share = sum(weights[r.place - 1 : r.place - 1 + r.ties]) / sum(weights) / r.ties
        assert abs(getattr(r, "any") - share) < 2e-9
        assert r.limited == (getattr(r, "any") if r.n <= 100 else 0)
    rungs = {(r.n_players, r.position): float(r.percentage) for r in payout_ladder(spark, NOW, 120).collect()}
    for r in got:
        if r.ties == 1 and r.n <= 120:
            assert abs(getattr(r, "any") - rungs.get((r.n, r.place), 0)) < 1.5e-9


def test_every_field_has_its_rungs_or_none(spark):
    fields = spark.createDataFrame([(4,), (4,), (101,), (None,)], "n_players long")
    rows = field_ladders(fields, payout_ladder(spark, NOW)).collect()
    assert sorted((r.n_players or 0, r.position or 0) for r in rows) == [(0, 0), (4, 1), (4, 2), (101, 0)]


def test_totals_by_year_start_anew_and_carry_no_year(spark):
    rows = [("a", date(2025, 12, 30), 1), ("a", date(2025, 12, 31), 2), ("a", date(2025, 12, 31), 4), ("a", date(2026, 1, 1), 8),
            (None, date(2026, 1, 1), 16), (None, date(2026, 1, 2), 32), ("a", None, 64), ("b", None, None)]
    table = spark.createDataFrame(rows, "grp string, day date, amount int")
    totals = running_totals(table, ["grp"], "day", "amount", "total", by_year=True)
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "year(" in plan[: plan.index("Exchange hashpartitioning")]
    assert {(r.grp, r.day, r.total) for r in totals.collect()} == {
        ("a", date(2025, 12, 30), 1), ("a", date(2025, 12, 31), 7), ("a", date(2026, 1, 1), 8),
        (None, date(2026, 1, 1), 16), (None, date(2026, 1, 2), 48), ("a", None, 64), ("b", None, None),
    }
