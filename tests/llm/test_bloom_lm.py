"""Language model: exact base scores, counts read back from the filter, awkward rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyboard.llm import bloom_lm
from tests.llm.cases import LOWER, documents, empty, words

END = object()


def split(text):
    return [*words((text or "").translate(LOWER)), END]


def is_held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def check(table):
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    counts = Counter(t for doc, text in rows if not is_held_out(doc) for t in split(text))
    total, distinct = sum(counts.values()), len(counts)
    expected = []
    for doc, text in rows:
        own = split(text)
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        expected.append((repr(doc), is_held_out(doc), len(own), sum(counts[t] > 0 for t in own), total, round(base, 5)))
    found = bloom_lm.score(table, table.where(~bloom_lm.held_out(F.col("doc_id")))).collect()
    mine = [(repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found]
    assert sorted(x[:5] for x in mine) == sorted(x[:5] for x in expected)
    for a, b in zip(sorted(mine), sorted(expected), strict=True):
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-4)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in found)
    return found


@pytest.mark.parametrize("frequent", [1 << 20, 300])
def test_base_scores_are_exact(spark, frequent, monkeypatch):
    monkeypatch.setattr(bloom_lm, "FREQUENT", frequent)
    found = check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


def test_awkward_rows(spark):
    check(documents(spark))
    assert bloom_lm.score(empty(spark), empty(spark)).collect() == []
    nothing = bloom_lm.score(documents(spark), empty(spark)).collect()
    assert {(r.n_known, r.train_tokens) for r in nothing} == {(0, 0)}


def test_filter_reads_counts_back(spark):
    rng = np.random.RandomState(2)
    keys = np.unique(rng.randint(0, 1 << 24, 20_000))
    counts = np.maximum(1, (rng.pareto(1.0, len(keys)) * 2).astype(np.int64))
    table = spark.createDataFrame([(int(k), int(n)) for k, n in zip(keys, counts, strict=True)], "key long, n long")
    bits, made = bloom_lm.build_filter(table)
    model = bloom_lm.Model(1, 1, keys[:0], keys[:0], keys[:0], np.zeros(1), made, bits)
    read = model.pair_counts(keys)
    exact = bloom_lm.count_of(bloom_lm.level(counts))
    assert (read >= exact - 1e-9).all()  # a stored level is never missed
    assert np.mean(read == exact) > 0.98
    absent = model.pair_counts(np.arange(1 << 24, (1 << 24) + 20_000))
    assert np.mean(absent > 0) < 0.02
    assert (np.abs(np.log2(exact / counts)) < 0.6).all()


def rare_phrases(spark):
    """Frequent words that fill the classes, and rare ones that always stand in the same order."""
    common = [f"c{i}" for i in range(bloom_lm.CLASSES + 20)]
    rows = [(i, " ".join(common), "en", "a") for i in range(12)]
    rows += [(100 + i, " ".join(f"rare{j}" for j in range(40)), "en", "a") for i in range(4)]
    order = np.random.RandomState(1).permutation(40)
    asked = [(1, " ".join(f"rare{j}" for j in range(40)), "en", "a"), (2, " ".join(f"rare{j}" for j in order), "en", "a")]
    return documents(spark, asked), documents(spark, rows)


@pytest.mark.parametrize("frequent, bits", [(1 << 20, 1 << 30), (300, 1 << 30), (1 << 20, 1 << 12), (300, 1 << 12)])
def test_phrases_of_rare_words_are_known(spark, frequent, bits, monkeypatch):
    monkeypatch.setattr(bloom_lm, "FREQUENT", frequent)
    monkeypatch.setattr(bloom_lm, "MOST_BITS", bits)
    asked, training = rare_phrases(spark)
    found = {r.doc_id: r for r in bloom_lm.score(asked, training).collect()}
    assert found[1].base_score == pytest.approx(found[2].base_score)
    # Of 40 words 39 always follow the same one: 0.7 of their probability is sure.
    assert found[1].score / 40 > math.log10(0.5) and found[2].score < 2 * found[1].score


def test_scores_do_not_depend_on_what_is_broadcast(spark, monkeypatch):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    training = table.where(~bloom_lm.held_out(F.col("doc_id")))
    whole = {r.doc_id: r for r in bloom_lm.score(table, training).collect()}
    # The frequent words are still more than the classes; no pair is broadcast, so none is met by chance.
    monkeypatch.setattr(bloom_lm, "FREQUENT", 15_000)
    monkeypatch.setattr(bloom_lm, "MOST_BITS", 0)
    found = {r.doc_id: r for r in bloom_lm.score(table, training).collect()}
    apart = sum(abs(found[doc].score - whole[doc].score) for doc in whole)
    assert apart < 0.005 * sum(abs(r.score) for r in whole.values())


def test_tokens_are_looked_up_by_leading_bits(monkeypatch):
    monkeypatch.setattr(bloom_lm, "INDEX_BITS", 3)
    rng = np.random.default_rng(5)
    frequent = np.sort(np.concatenate([rng.integers(-(2**63), 2**63 - 1, 200), [-(2**63), 2**63 - 1]]))
    counts = rng.integers(1, 1000, len(frequent))
    for size in (len(frequent), 1, 0):
        most, n = frequent[:size], counts[:size]
        model = bloom_lm.Model(int(n.sum()), size, most, n, most[::3], np.zeros(2), np.zeros(0, dtype=np.uint8), 0)
        found = np.concatenate([frequent, rng.integers(-(2**63), 2**63 - 1, 300), frequent[:-1] + 1, frequent[1:] - 1])
        known = dict(zip(most.tolist(), n.tolist(), strict=True))
        exact, numbers, logs, shares = model.looked_up(found)
        assert exact.tolist() == [known.get(t, -1) for t in found.tolist()]
        assert numbers.tolist() == bloom_lm.class_of(found, model.classes).tolist()
        expected = np.where(exact >= 0, model.smoothed(np.maximum(exact, 0)), 0.0)
        assert logs.tolist() == expected.tolist()
        assert shares.tolist() == (10.0**expected).tolist()


def test_pairs_are_shuffled_and_kept_in_few_rows(spark, monkeypatch):
    monkeypatch.setattr(bloom_lm, "MOST_BLOCKS", 8)
    rng = np.random.RandomState(3)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.3, 60) % 500) for _ in range(40)]
    table = documents(spark, [(i, text, "en", "a") for i, text in enumerate(texts)]).repartition(5)
    classes = np.unique(bloom_lm.tokens([texts[0].encode()])[0])[:20]
    expected = Counter()
    for text in texts:
        found, starts = bloom_lm.tokens([text.encode()])
        by_class, by_token = bloom_lm.pair_keys(found, starts, bloom_lm.class_of(found, classes))
        expected.update(by_class.tolist())
        expected.update(by_token[by_token != by_class].tolist())
    counts = bloom_lm.counted(table, classes)
    rows = counts.collect()
    parts = bloom_lm.key_parts(spark)
    assert len(rows) <= parts < len(expected) / 10
    found = {}
    for r in rows:
        keys = np.frombuffer(r.keys, dtype=np.int64)
        assert set((keys & (parts - 1)).tolist()) == {r.part}
        found |= dict(zip(keys.tolist(), r.levels, strict=True))
    assert found == {key: int(bloom_lm.level(np.array([n]))[0]) for key, n in expected.items()}
    assert bloom_lm.pairs_by_level(counts) == Counter(found.values())
    low = {r.key: r.n for r in bloom_lm.below_level(counts, 3).collect()}
    assert low == {key: bloom_lm.COUNTS[q] for key, q in found.items() if q < 3}


def test_levels_of_class_pairs_are_read_once(spark):
    keys = np.unique(np.random.RandomState(4).randint(0, (bloom_lm.CLASSES + 2) ** 2, 3000))
    table = spark.createDataFrame([(int(k), i % 90 + 1) for i, k in enumerate(keys[::2])], "key long, n long")
    bits, made = bloom_lm.build_filter(table)
    model = bloom_lm.Model(1, 1, keys[:0], keys[:0], keys[:0], np.zeros(1), made, bits)
    read, levels = [], model.levels
    model.levels = lambda asked: read.extend(asked.tolist()) or levels(asked)
    asked = np.concatenate([keys, keys[::-1]])
    first = model.class_pair_counts(asked)
    assert model.class_pair_counts(asked).tolist() == first.tolist() == model.pair_counts(asked).tolist()
    assert read[: len(keys)] == keys.tolist() and len(read) == len(keys) + len(asked)
