"""Base counts against a plain count, the ratio against a plain sum, awkward rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyboard.llm import quality
from tests.llm.cases import documents, empty, labels, words


def counted(text):
    found = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    places = {}
    for i in range(len(found) - 4):
        places.setdefault(tuple(found[i : i + 5]), []).append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)


def shape(word):
    out = ""
    for c in word:
        kind = "A" if c.isupper() else "a" if c.islower() else "o" if c.isalpha() else "0" if c in "0123456789" else c
        out += kind if kind not in "Aao0" or not out.endswith(kind) else ""
    return out


REPEATS = [
    "a b c d e " * 5,
    "one two three four five six one two three four five",
    "x x x x x x x x",
    "\n".join(["the same line again and again"] * 4 + ["   ", "other", "", "other "]),
    "# * $ %% && || << >> word",
    "a b c d",
]


def test_counts_are_exact(spark):
    rows = [(100 + i, t, "en", "a") for i, t in enumerate(REPEATS)]
    table = documents(spark).unionByName(documents(spark, rows))
    found = quality.judge(table, labels(spark, []))
    texts = {}
    for r in table.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(counted(r.text))
    checked = 0
    for r in found.collect():
        mine = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert mine in texts[r.doc_id]
        assert r.base_failed == (mine[0] < 10 or 100 * mine[4] > 20 * mine[0])
        assert r.kept == (not r.base_failed) and r.score == 0
        checked += 1
    assert checked == 15 + len(REPEATS)


def test_ratio_is_the_plain_sum(spark):
    folder = "/root/testdata/sf0.001"
    table, marks = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    good = {r.doc_id for r in marks.collect() if r.quality == 1}
    raw, target, grams = Counter(), Counter(), {}
    for r in table.collect():
        found = [shape(w) for w in words(r.text)]
        grams[r.doc_id] = list(zip(found, [*found[1:], None], strict=True))
        raw.update(grams[r.doc_id])
        if r.doc_id in good:
            target.update(grams[r.doc_id])
    n, m, k = sum(raw.values()), sum(target.values()), quality.PRIOR
    # Few shape pairs share a bucket, so scores differ only a little from those without hashing.
    checked = 0
    for r in quality.judge(table, marks).collect():
        own = grams[r.doc_id]
        plain = sum(math.log((target[g] + k * raw[g] / n) / (m + k)) - math.log(raw[g] / n) for g in own)
        if own and all(re.fullmatch(r"[Aa]+[.,]?", s or "") for g in own for s in g if s):
            assert r.score == pytest.approx(plain / len(own), abs=0.05)
            checked += 1
    assert checked > 50


def test_labelled_documents_are_told_apart(spark):
    folder = "/root/testdata/sf0.01"
    table, marks = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    judged = quality.judge(table, marks).join(marks, "doc_id").where(~F.col("base_failed"))
    rates = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[1] > 0.99 and rates[0] < 0.05


def bucket(word):
    """The bucket of a word, by another implementation of the hash."""
    return xxhash.xxh64(word.lower().encode(), seed=42).intdigest() % quality.WORD_BUCKETS


def test_word_ratio_and_limit_are_the_plain_ones(spark):
    folder = "/root/testdata/sf0.001"
    table, marks = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    apart = {r.doc_id: r.apart for r in quality.trusted_ids(marks).collect()}
    assert set(apart) == {r.doc_id for r in marks.collect() if r.quality == 1} and 0 < sum(apart.values()) < len(apart)
    rows = [(r.doc_id, [bucket(w) for w in words(r.text)]) for r in table.collect()]
    raw = Counter(b for _, own in rows for b in own)
    target = Counter(b for doc, own in rows if apart.get(doc) is False for b in own)
    n, m, k = sum(raw.values()), sum(target.values()), quality.PRIOR
    weight = {b: math.log((target[b] + k * raw[b] / n) / (m + k)) - math.log(raw[b] / n) for b in raw}
    plain = {doc: sum(weight[b] for b in own) / len(own) if own else 0.0 for doc, own in rows}
    found = {r.doc_id: r for r in quality.judge(table, marks).collect()}
    learned = quality.weights(table, marks)
    assert all(found[doc].word_score == pytest.approx(plain[doc], abs=learned.step / 2 + 1e-6) for doc, own in rows if own)
    low, middle = np.quantile([plain[doc] for doc, own in rows if apart.get(doc) and len(own) >= 10], [0.01, 0.5])
    assert learned.limit == pytest.approx(2 * low - middle, abs=1.5 * learned.step + 1e-6)
    for r in found.values():
        assert r.kept == (not r.base_failed and r.score >= quality.THRESHOLD and r.word_score >= learned.limit)


def test_all_trusted_documents_count(spark):
    """11,000 documents labelled good: every one makes the target or the limit."""
    marks = spark.range(11_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert quality.trusted_ids(marks).count() == 11_000
    table = spark.range(11_000).selectExpr("id as doc_id", "concat('Word ', id, repeat(' and so on', 4)) as text")
    learned = quality.weights(table, marks)
    # A word that all have is as frequent in the target as in the raw corpus, the number of a document is not.
    apart = {r.doc_id: r.apart for r in quality.trusted_ids(marks).collect()}
    level = {i: learned.words[bucket(str(i))] for i in apart}
    assert min(x for i, x in level.items() if not apart[i]) > sum(x for i, x in level.items() if apart[i]) / sum(apart.values())
    assert learned.limit > float("-inf")


def test_lists_of_words_go(spark):
    folder = "/root/testdata/sf0.01"
    table, marks = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    junk = "buy cheap watches casino click free money win bonus loan offer discount pills online".split()
    rng = np.random.RandomState(4)
    lists = [(10**9 + i, " ".join(rng.choice(junk, rng.randint(12, 300))), "en", "a") for i in range(40)]
    judged = quality.judge(table.select("doc_id", "text").union(documents(spark, lists).select("doc_id", "text")), marks)
    rows = judged.join(marks, "doc_id", "left").where(~F.col("base_failed")).collect()
    share = lambda kept: sum(kept) / len(kept)
    assert share([r.kept for r in rows if r.quality == 1]) > 0.98
    fresh = [r for r in judged.where(F.col("doc_id") >= 10**9).collect()]
    assert len(fresh) == 40 and all(r.score > quality.THRESHOLD for r in fresh if not r.base_failed)
    assert sum(r.kept for r in fresh) < 4


def test_awkward_rows(spark):
    table = documents(spark)
    marks = labels(spark, [(1, 1, 0), (1, 0, 0), (7, 1, 0), (None, 1, None), (2, None, None), (99, 1, 0)])
    kept = quality.keep_good(table, marks, threshold=-50.0)
    assert kept.schema == table.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 2, 8, 8, None]))
    assert quality.judge(empty(spark), marks).collect() == []
    assert quality.keep_good(empty(spark), marks).collect() == []


def test_no_python_on_the_main_path(spark):
    folder = "/root/testdata/sf0.001"
    table, marks = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    plan = quality.judge(table, marks)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
