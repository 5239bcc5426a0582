"""Raking against plain loops and DuckDB, drawing, awkward rows."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from checks.compare import canonical, oracle_rows
from tallyboard.llm import mixing
from tallyboard.llm.oracles import oracle_sql
from tallyboard.llm.queries import op3_mixing
from tests.llm.cases import documents, empty

CELLS = [("a", "en", "x", 700), ("a", "de", "x", 50), ("b", "en", "y", 100), ("b", "de", "x", 90), (None, "en", "x", 60),
         ("c", None, "y", 10), ("d", "en", "x", 0)]


def raked(cells, targets, rounds):
    weight = {c[:3]: float(c[3]) for c in cells}
    for _ in range(rounds):
        for i, _ in enumerate(mixing.DIMENSIONS):
            total = defaultdict(float)
            for key, w in weight.items():
                total[key[i]] += w
            weight = {k: w * targets[i].get(k[i], 0) / total[k[i]] if total[k[i]] else 0.0 for k, w in weight.items()}
    return weight


def tempered(cells):
    found = []
    for i in range(3):
        total = defaultdict(float)
        for c in cells:
            total[c[i]] += c[3]
        found.append({k: v**mixing.TEMPER for k, v in total.items()})
    return found


def test_raking_equals_plain_loops_and_meets_the_targets(spark):
    cells = spark.createDataFrame(CELLS, "source string, lang string, topic string, tokens long")
    found = {(r.source, r.lang, r.topic): r.weight for r in mixing.rake(cells, rounds=30).collect()}
    targets = tempered(CELLS)
    expected = raked(CELLS, targets, 30)
    assert found == pytest.approx(expected, rel=1e-9)
    by_topic = defaultdict(float)
    for key, w in found.items():
        by_topic[key[2]] += w
    assert by_topic["x"] / by_topic["y"] == pytest.approx(targets[2]["x"] / targets[2]["y"], rel=1e-9)


def test_given_shares(spark):
    cells = spark.createDataFrame(CELLS, "source string, lang string, topic string, tokens long")
    shares = spark.createDataFrame([("en", 0.25), ("de", 0.75)], "lang string, share double")
    found = {(r.source, r.lang, r.topic): r.weight for r in mixing.rake(cells, {"lang": shares}, rounds=20).collect()}
    targets = tempered(CELLS)
    targets[1] = {"en": 0.25, "de": 0.75}
    assert found == pytest.approx(raked(CELLS, targets, 20), rel=1e-6, abs=1e-9)
    assert found[("c", None, "y")] == 0


def plain_scale(cells, drawn):
    """The scale for [(tokens, weight)] by bisection."""
    budget, low, high = drawn * sum(t for t, _ in cells), 0.0, max(t / w for t, w in cells if w) * 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(t, mid * w) for t, w in cells) < budget else (low, mid)
    return high


def test_scale_meets_the_budget(spark):
    cells = [(1000, 300.0), (10, 200.0), (500, 500.0), (1, 100.0), (0, 0.0), (700, 0.0), (90, 1.0)]
    table = spark.createDataFrame(cells, "tokens long, weight double")
    for drawn in (0.001, 0.01, 0.2, 0.5, 0.6):
        scale = mixing.scale_of(table, drawn)
        assert scale == pytest.approx(plain_scale(cells, drawn), rel=1e-9)
        assert sum(min(t, scale * w) for t, w in cells) == pytest.approx(drawn * 2301, rel=1e-9)
    for drawn in (0.7, 1.0):  # more than the cells with a weight have: all of them are taken whole
        assert all(mixing.scale_of(table, drawn) * w >= t for t, w in cells if w)
    assert mixing.scale_of(table.where("weight = 0"), 0.5) == 0
    assert mixing.scale_of(table.limit(0), 0.5) == 0


def test_a_stray_document_changes_next_to_nothing(spark):
    rows = [(i, f"{'data ' if i % 7 == 0 else ''}some words of text number {i} " * (1 + i % 5), "en" if i % 3 else "de", f"s{i % 4}") for i in range(2000)]
    plain = documents(spark, rows)
    stray = plain.unionByName(documents(spark, [(9999, "twelve words of a language that no other document has at all, stray", "xx", "new")]))
    expected = [mixing.draw(t).agg(F.sum("probability"), F.sum("n_tokens"), F.sum(F.col("n_tokens") * F.col("probability"))).first() for t in (plain, stray)]
    for _, tokens, drawn in expected:
        assert drawn == pytest.approx(mixing.DRAWN * tokens, rel=1e-6)
    assert abs(expected[1][0] - expected[0][0]) < 1
    assert mixing.draw(stray).where("doc_id = 9999").first().probability == 1


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    table = op3_mixing(spark, folder)
    names, rows = oracle_rows(folder, oracle_sql()["op3_mixing"])
    assert canonical(table.columns, [tuple(r) for r in table.collect()]) == canonical(names, rows)


def test_drawn_tokens_come_near_the_targets(spark):
    table = op3_mixing(spark, "/root/testdata/sf0.1").persist()
    expected = {r.lang: r.x for r in table.groupBy("lang").agg(F.sum(F.col("n_tokens") * F.col("probability")).alias("x")).collect()}
    found = {r.lang: r.x for r in table.where("drawn").groupBy("lang").agg(F.sum("n_tokens").alias("x")).collect()}
    table.unpersist()
    for lang in expected:
        assert found[lang] / sum(found.values()) == pytest.approx(expected[lang] / sum(expected.values()), abs=0.03)


def test_awkward_rows(spark):
    table = documents(spark)
    rows = mixing.draw(table).collect()
    assert len(rows) == 15
    assert all(0 <= r.probability <= 1 for r in rows)
    assert all(not r.drawn for r in rows if r.probability == 0)
    assert len({r.drawn for r in rows if r.doc_id == 2}) == 1
    kept = mixing.keep_drawn(table)
    assert kept.schema == table.schema
    assert kept.count() == sum(r.drawn for r in rows)
    assert mixing.draw(empty(spark)).collect() == []
    assert mixing.keep_drawn(empty(spark)).collect() == []


def test_no_python_on_the_main_path(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = mixing.draw(table)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
