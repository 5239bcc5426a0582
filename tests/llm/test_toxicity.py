"""Severity: labelled documents that were not learned from, order of thresholds, awkward rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tallyboard.llm import toxicity
from tallyboard.llm.common import word_hashes
from tests.llm.cases import documents, empty, labels


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    table, marks = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    learned_from = marks.where("doc_id % 2 = 0")
    rest = marks.where("doc_id % 2 = 1").withColumnRenamed("toxic", "truth")
    rows = toxicity.severity(table, learned_from).join(rest, "doc_id").select("truth", "toxic", "severity").collect()
    bad = [r for r in rows if r.truth == 1]
    good = [r for r in rows if r.truth == 0]
    # About one toxic label in twenty stands on a text without any toxic word.
    assert np.mean([r.toxic for r in bad]) > 0.85
    assert np.mean([r.toxic for r in good]) < 0.01
    assert np.mean([r.severity for r in bad]) > 10 * np.mean([r.severity for r in good])
    assert all(0 <= r.severity <= toxicity.GRADES - 1 for r in rows)


def test_thresholds_are_ordered_and_severity_rises_with_terms(spark):
    rows = [(i, f"plain text number {i} about nothing", "en", "a") for i in range(200)]
    rows += [(1000 + i, "text with " + " ".join(f"bad{j}" for j in range(1 + i % 6)), "en", "a") for i in range(120)]
    table = documents(spark, rows)
    marks = labels(spark, [(r[0], 1, int(r[0] >= 1000)) for r in rows])
    model = toxicity.learn(table, marks)
    assert (np.diff(model.thresholds) > 0).all()
    found = {r.doc_id: r for r in toxicity.severity(table, marks).collect()}
    assert found[0].severity < found[1000].severity < found[1002].severity < found[1005].severity
    assert found[1005].grade > found[1000].grade >= 1 and not found[0].toxic


def plain(text, model):
    """(severity, grade, probability of grade 1 and above, number of terms) by the formula, term by term."""
    times = Counter(re.findall("[a-z0-9]+", text.lower()))
    in_bucket = Counter()
    for word, n in times.items():
        in_bucket[int(word_hashes([word.encode()])[0][0]) % toxicity.BUCKETS] += n
    used = {b: n for b, n in in_bucket.items() if model.weights[b] != 0}
    x = sum(float(model.weights[b]) * (1 + math.log2(n)) for b, n in used.items())
    above = [1 - 1 / (1 + math.exp(-(t - x))) for t in model.thresholds]
    each = [a - b for a, b in zip([1, *above], [*above, 0], strict=True)]
    return sum(k * p for k, p in enumerate(each)), max(range(len(each)), key=each.__getitem__), above[0], len(used)


def test_severity_equals_the_plain_formula(spark):
    rows = [(i, f"plain text number {i} about nothing", "en", "a") for i in range(200)]
    rows += [(1000 + i, "Text, with " + " ".join(f"BAD{j}!" for j in range(1 + i % 6)), "en", "a") for i in range(120)]
    marks = labels(spark, [(r[0], 1, int(r[0] >= 1000)) for r in rows])
    rows += [(2000, "bad0 bad0 bad0. Bad1? bad5 " * 400, "en", "a"), (2001, "...", "en", "a"), (2002, "", "en", "a")]
    rows += [(2003, "text bad0-bad1 text plain about", "en", "a"), (2004, "plain " * 5000 + "bad2", "en", "a")]
    table = documents(spark, rows)
    model = toxicity.learn(table, marks)
    texts = {r[0]: r[1] for r in rows}
    found = toxicity.severity(table, marks).collect()
    assert len(found) == len(rows)
    for r in found:
        severity, grade, p, terms = plain(texts[r.doc_id], model)
        assert (r.severity, r.p_toxic) == pytest.approx((severity, p), abs=1e-5)
        assert r.terms == terms and r.toxic == (p >= 0.5) and r.grade == grade


def test_awkward_rows(spark):
    marks = labels(spark, [(1, 1, 0), (1, 0, 1), (3, 0, 1), (None, 1, 1), (99, 1, 1), (7, None, None)])
    rows = toxicity.severity(documents(spark), marks).collect()
    assert len(rows) == 15 and all(r.severity is not None for r in rows)
    none = toxicity.severity(documents(spark), labels(spark, [])).collect()
    assert {(r.severity, r.toxic, r.grade) for r in none} == {(0.0, False, 0)}
    assert toxicity.severity(empty(spark), marks).collect() == []
