"""Near duplicates against all pairs, components against a union of sets, awkward rows."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyboard.llm import near_duplicates as nd
from tallyboard.llm.components import components
from tests.llm.cases import LOWER, documents, empty, words


def plain_set(text, size):
    found = words((text or "").translate(LOWER))
    if len(found) < size:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1))


def brute(rows, size, percent):
    """doc_id -> (set size, least doc_id of its group); all pairs that share a shingle are compared."""
    sets = [(doc, plain_set(text, size)) for doc, text in rows]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, (_, own) in enumerate(sets):
        for shingle in own:
            holders[shingle].append(i)
    pairs = {(a, b) for at in holders.values() for x, b in enumerate(at) for a in at[:x]}
    for a, b in pairs:
        x, y = sets[a][1], sets[b][1]
        if 100 * len(x & y) >= percent * len(x | y):
            i, j = find(a), find(b)
            parent[max(i, j)] = min(i, j)
    least = {}
    for i, (doc, _) in enumerate(sets):
        key = (doc is None, doc if doc is not None else 0)
        least[find(i)] = min(least.get(find(i), key), key)
    return sorted((repr(doc), len(own), repr(None if least[find(i)][0] else least[find(i)][1])) for i, (doc, own) in enumerate(sets))


def found(table, size, percent=80):
    rows = nd.near_duplicates(table, size, percent).collect()
    for r in rows:
        assert r.kept == (r.doc_id == r.component_id)
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in rows)


@pytest.mark.parametrize("size", [4, 5])
def test_given_table(spark, size):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    assert found(table, size) == brute(rows, size, 80)


def test_groups_of_edited_copies(spark):
    """Copies with more and more edits: chains of links, pairs on both sides of the limit."""
    rng = random.Random(5)
    rows, doc = [], 1000
    for _ in range(6):
        base = [f"w{rng.randrange(4000)}" for _ in range(160)]
        rows.append((doc, " ".join(base)))
        for k in range(40):
            doc -= 1
            copy = list(base if k % 3 else rows[-1][1].split())
            for _ in range(rng.randrange(1, 9)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            rows.append((doc, " ".join(copy)))
        doc -= 1
    table = documents(spark, [(d, t, "en", "a") for d, t in rows])
    assert found(table, 4) == brute(rows, 4, 80)


def test_awkward_rows(spark):
    table = documents(spark)
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    expected = brute(rows, 4, 80)
    got = found(table.where("doc_id is not null"), 4)
    assert got == [x for x in expected if x[0] != "None"]
    assert len(nd.near_duplicates(table, 4).collect()) == 15
    assert found(empty(spark), 4) == []


def test_keeping_leaves_one_of_each(spark):
    table = documents(spark)
    kept = nd.keep_first(table)
    assert kept.schema == table.schema
    # The near copy with a null id and the copies of document 1 go; texts without words stay.
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(map(str, [1, 3, 4, 5, 6, 7, 8, 8, None, 9, 10, 11]))
    assert nd.keep_first(empty(spark)).collect() == []


def test_rows_without_words_all_stay(spark):
    rows = [(None, t, lang, "a") for t in (None, "", " \n") for lang in ("en", "en", "de", None)]
    text = "one text of more than five words, told again and again"
    rows += [(1, text, lang, source) for lang, source in (("en", "b"), ("de", "a"), ("en", "a"), ("de", "a"))]
    table = documents(spark, rows)
    kept = nd.keep_first(table).collect()
    assert sorted(str(r) for r in kept if r.doc_id is None) == sorted(str(r) for r in table.where("doc_id is null").collect())
    stays = [r for r in kept if r.doc_id == 1]
    assert len(stays) == 1
    for parts in (1, 3, 5):
        again = nd.keep_first(table.orderBy(F.rand(parts)).repartition(parts)).where("doc_id = 1").collect()
        assert again == stays


def test_estimates_are_corrected_for_chance():
    rng = np.random.RandomState(3)
    common = rng.randint(0, 2**62, 900).astype(np.uint64)
    a, b = (np.concatenate([common, rng.randint(0, 2**62, 100).astype(np.uint64)]) for _ in range(2))
    low = np.uint64(3)
    agree = np.mean((nd.minima(a) & low) == (nd.minima(b) & low))
    assert abs((agree - 0.25) / 0.75 - 900 / 1100) < 0.2
    assert 60 < nd.least_agreeing(80) < nd.least_agreeing(95) < nd.HASHES


def test_packed_signatures_count_agreeing_places(spark):
    rng = np.random.RandomState(4)
    a, b = (rng.randint(0, 4, nd.HASHES).astype(np.uint64) for _ in range(2))
    row = {f"a{i}": int(x) for i, x in enumerate(nd.packed(a))} | {f"b{i}": int(x) for i, x in enumerate(nd.packed(b))}
    one = spark.createDataFrame([row])
    left = one.select(F.lit(1).alias("k"), *[F.col(f"a{i}").alias(f"s{i}") for i in range(nd.LANES)]).alias("l")
    right = one.select(F.lit(1).alias("k"), *[F.col(f"b{i}").alias(f"s{i}") for i in range(nd.LANES)]).alias("r")
    joined = left.join(right, F.col("l.k") == F.col("r.k")).select(nd.agreeing("l", "r").alias("n"))
    assert joined.first().n == int((a == b).sum())


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1040)] + [(7, 7), (500, 499)]
    links += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    table = components(spark.createDataFrame(links, "u long, v long"))
    assert {r.u: r.v for r in table.collect()} == {x: find(x) for x in parent if find(x) != x}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
