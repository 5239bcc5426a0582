"""Fingerprints against a parse of plain strings, and the order of the documents."""

import hashlib
import re

from tallyboard.llm.fingerprints import fingerprint, fingerprint_documents, likeness
from tests.llm.cases import DOCUMENTS, documents, empty

NEVER = -(2**63)


def phrases(text):
    """The dictionary of a Lempel-Ziv parse, on strings."""
    known, now = set(), b""
    for symbol in re.findall(rb"[^\x20\x09-\x0d]{1,8}[\x20\x09-\x0d]*|[\x20\x09-\x0d]+", text.encode()):
        now += symbol
        if now not in known:
            known.add(now)
            now = b""
    return known


def near(a, b):
    x, y = phrases(a), phrases(b)
    return len(x & y) / len(x | y) if x and y else float(bool(x) == bool(y))


def test_equal_texts_and_small_sets_are_exact():
    a = "one two three four five six seven eight nine ten"
    b = "one two three four five six eleven twelve"
    assert likeness(fingerprint(a), fingerprint(a)) == 1.0
    assert abs(likeness(fingerprint(a), fingerprint(b)) - near(a, b)) < 1e-12
    assert likeness(fingerprint(""), fingerprint(None)) == 1.0
    assert likeness(fingerprint(""), fingerprint(a)) == 0.0


def test_large_sets_are_estimated():
    a = " ".join(f"w{i} v{i % 7}" for i in range(4000))
    b = " ".join(f"w{i} v{i % 7}" for i in range(1000, 5000))
    assert abs(likeness(fingerprint(a), fingerprint(b)) - near(a, b)) < 0.15


def test_every_row_meets_the_next_in_descending_order(spark):
    rows = [(r[0], r[1] or "") for r in DOCUMENTS]
    rows.sort(key=lambda r: (-(r[0] if r[0] is not None else NEVER), r[1]))
    expected = []
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        sha = hashlib.sha256(changed.encode()).hexdigest()
        expected.append((doc, len(text), sha, round(likeness(fingerprint(text), fingerprint(changed)), 9),
                         round(likeness(fingerprint(text), fingerprint(following)), 9)))
    found = fingerprint_documents(documents(spark)).collect()
    mine = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in found]
    assert sorted(map(repr, mine)) == sorted(map(repr, expected))
    prints = {}
    for r in found:
        prints.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in prints.values())


def test_one_row_follows_itself_and_no_row_is_fine(spark):
    only = fingerprint_documents(documents(spark, DOCUMENTS[:1])).collect()
    assert len(only) == 1 and only[0].near_next == 1.0
    assert fingerprint_documents(empty(spark)).collect() == []


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {r.doc_id: r for r in fingerprint_documents(table).collect()}
    texts = {r.doc_id: r.text for r in table.collect()}
    order = sorted(texts, reverse=True)
    for a, b in zip(order, order[1:] + order[:1], strict=True):
        half = len(texts[a]) // 2
        changed = texts[a][: len(texts[a]) - half] + texts[b][:half]
        assert found[a].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert abs(found[a].near_edited - near(texts[a], changed)) < 0.2
