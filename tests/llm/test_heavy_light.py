"""The size-aware set join against all pairs, on both sides of its boundary."""

import random
import re
from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tallyboard.llm import heavy_light as hl
from tests.llm.cases import LOWER, documents, empty
from tests.llm.test_near_duplicates import brute


def found(table, size=4, percent=85):
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in hl.linked(table, size, percent).collect())


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    assert found(table) == brute(rows, 4, 85)


def edited_copies(rng):
    """Copies of short and long texts with a few edits: sets of 1 to 150 shingles, chains, both sides of the limit."""
    rows, doc = [], 2000
    for length in [4, 6, 8, 10, 12, 14, 17, 20, 23, 26, 30, 160]:
        base = [f"w{rng.randrange(4000)}" for _ in range(length)]
        rows.append((doc, " ".join(base)))
        for k in range(14):
            doc -= 1
            copy = list(base if k % 3 else rows[-1][1].split())
            for _ in range(rng.randrange(0, 1 + length // 40) + (length > 30)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            # Words that go or come at the ends change the size of the set.
            copy = copy[rng.randrange(2) :] + [f"y{rng.randrange(10**6)}" for _ in range(rng.randrange(3) if k % 2 else 0)]
            rows.append((doc, " ".join(copy)))
        doc -= 1
    return rows


@pytest.mark.parametrize("boundary", [None, 24])
def test_edited_copies_whatever_the_boundary(spark, monkeypatch, boundary):
    rows = edited_copies(random.Random(11))
    expected = brute(rows, 4, 85)
    assert len({c for _, _, c in expected}) < len(expected)
    if boundary is not None:
        monkeypatch.setattr(hl, "choose_boundary", lambda *_: boundary)
    assert found(documents(spark, [(d, t, "en", "a") for d, t in rows])) == expected


def test_shared_passage_links_nothing_by_itself(spark):
    """A passage in many documents, longer than their prefixes, leaves clean documents alone."""
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) + " " + passage) for i in range(150)]
    rows += [(1000 + i, passage + f" z{i}") for i in range(20)]
    assert found(documents(spark, [(d, t, "en", "a") for d, t in rows])) == brute(rows, 4, 85)


def test_awkward_rows(spark):
    table = documents(spark)
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    assert found(table.where("doc_id is not null")) == [x for x in brute(rows, 4, 85) if x[0] != "None"]
    assert hl.linked(table).count() == 15
    assert found(empty(spark)) == []


def test_upper_case_and_white_space_do_not_count(spark):
    text = "One Two three FOUR five six seven"
    rows = [(2, text), (1, text.translate(LOWER).replace(" ", "\t \n")), (3, text.replace("One", "İne"))]
    assert found(documents(spark, [(d, t, "en", "a") for d, t in rows])) == brute(rows, 4, 85)


@pytest.mark.parametrize("percent", [80, 85])
def test_overlap_and_prefix_are_exact(percent):
    for n in range(1, 60):
        assert [m for m in range(1, 200) if 100 * min(n, m) >= percent * max(n, m)] == list(hl.partner_sizes(n, percent))
        for m in hl.partner_sizes(n, percent):
            links = [c for c in range(min(n, m) + 1) if 100 * c >= percent * (n + m - c)]
            assert hl.overlap(n, m, percent) == links[0]
            # Sets that share so much cannot miss each other's prefixes.
            assert n - links[0] < hl.prefix_length(n, percent)


def test_boundary_follows_cost(spark):
    def rows(entries):
        return spark.createDataFrame(entries, "key long, n long, scanned long")

    # Lists that nobody else is on: only what is as cheap by subsets.
    assert 4 <= hl.choose_boundary(rows([(i, 4 + i % 20, 0) for i in range(100)]), 85) <= 6
    # Long lists: subsets as far as they go.
    assert hl.choose_boundary(rows([(i, 4 + i % 30, 10**6) for i in range(100)]), 85) == hl.LARGEST_SMALL
    # Only sets of 24 have long lists, but enumerating sets of 23 is dear.
    assert hl.choose_boundary(rows([(i, 23, 0) for i in range(1000)] + [(5000, 24, 3000)]), 85) < 23


def test_subsets_that_are_counted_are_those_enumerated():
    for n in range(1, 16):
        made = sum(1 for m in hl.partner_sizes(n, 85) for _ in combinations(range(n), min(n, hl.overlap(n, m, 85))))
        assert hl.subsets(n, 85) == made


def test_bitmaps_never_rule_out_a_link(spark):
    rng = np.random.RandomState(5)
    for n in (20, 300, 5000):
        common = rng.randint(0, 2**62, n).astype(np.uint64)
        extra = rng.randint(0, 2**62, int(n * 0.17)).astype(np.uint64)
        a, b = common, np.concatenate([common, extra])
        bits = 64 * hl.LANES
        odd = [np.bincount((hl.mix(x) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1 for x in (a, b)]
        assert (odd[0] != odd[1]).sum() <= len(extra)


def test_frequencies_put_shared_shingles_last(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, f"{passage} own{i} words{i} of{i} document{i} here{i}", "en", "a") for i in range(200)]
    table = documents(spark, rows)
    held = hl.frequencies(table, 4)
    shared, own = (next(hl.sets_of([t], 4)) for t in (passage, "own1 words1 of1 document1"))
    assert hl.level_of(held, shared).min() >= 2 > hl.level_of(held, own).max() == 0
    sent = spark.sparkContext.broadcast(held)
    prefixes = [set(r.prefix) for r in hl.sketches(table, 4, 85, sent).collect()]
    # Fewer shingles are the document's own than its prefix takes; those all share come last.
    assert all(len(p) <= 5 for p in prefixes)


def test_ranges_of_a_task_are_summed_one_at_a_time(spark):
    """All ranges in one task, as adaptive execution deals a small input: their tables together would be 512 MB."""
    pages = np.arange(10, 1 << hl.RANGE_BITS, 1024)  # so that all of a table's memory is touched
    one = lambda places, by: pa.RecordBatch.from_arrays(
        [
            pa.array(places, pa.int32()),
            pa.array([np.array([p % 7, 9, *pages], dtype=np.uint16).tobytes() for p in places], pa.binary()),
            pa.array([np.array([p % 5 + by, by, *np.ones_like(pages)], dtype=np.uint32).tobytes() for p in places], pa.binary()),
        ],
        names=["place", "low", "counts"],
    )
    places = list(range(hl.RANGES))
    rows = [one(places, 1), one(places[::-1], 2)]
    parts = spark.createDataFrame([(i,) for i in range(2)], "i int").mapInArrow(
        lambda batches: (rows[i] for batch in batches for i in batch.column(0).to_pylist()), hl.COUNTS
    )

    def finish(table):
        held = int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) // 1024
        return np.array([min(255, held // 4), int(table.sum() % 256), table[9]], dtype=np.uint8)

    found = hl.slot_table(parts, finish).reshape(hl.RANGES, -1)
    assert found[:, 1].tolist() == [2 * (p % 5) + 6 + 2 * len(pages) for p in places]
    assert found[:, 2].tolist() == [3] * len(places)
    assert int(found[:, 0].max()) * 4 < 500


def test_lone_entries_leave_whatever_the_batches(spark):
    rng = random.Random(12)
    classes = []
    for key in range(300):
        prefix = sorted(rng.sample(range(600), 5))
        classes.append((key, 40, rng.randrange(3), prefix))
    table = spark.createDataFrame(classes, "key long, n long, hot long, prefix array<long>")
    cold = [(g, key) for key, _, hot, prefix in classes for g in prefix[: 5 - hot]]
    times = Counter(g for g, _ in cold)
    expected = [x for x in cold if times[x[0]] > 1] + [(g, key) for key, _, hot, prefix in classes for g in prefix[5 - hot :]]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for rows in ("1", "3", "1000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            assert sorted((r.g, r.key) for r in hl.shared_entries(table).collect()) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
