"""The audit of sources against a plain count in Python, the packing of terms, awkward rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyboard.llm import divergence as dv
from tests.llm.cases import LOWER, documents, empty

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, least, top=50):
    """(lang, source, part, item, value, rank) by definition."""
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        held[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= least]

        def share(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + (10**9 * (count[t] + 5)) // (total + 5 * len(kept)) for t in kept}

        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def found(table):
    return sorted(tuple(r) for r in dv.audit(table).collect())


def made(rng, size, sources=9, langs=3):
    words = [f"{'Äö' * (i % 3)}{'ab' * (i % 23)}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    rows = []
    for i in range(size):
        text = " ".join(rng.choice(words[: 40 + 90 * (i % 4)]) + rng.choice(["", "", "1", "-", "—"]) for _ in range(rng.randrange(60)))
        lang = f"l{i % langs}" if i % 11 else None
        # A hot source holds a third of all rows.
        rows.append((i, text.upper() if i % 5 == 0 else text, lang, "hot" if i % 3 == 0 else f"s{i % sources}"))
    return rows


@pytest.fixture
def rare_terms(monkeypatch):
    monkeypatch.setattr(dv, "LEAST_DOCUMENTS", 3)


def test_made_table(spark, rare_terms):
    rows = made(random.Random(2), 500)
    assert found(documents(spark, rows)) == plain(rows, 3)


@pytest.mark.parametrize(("terms", "sources"), [(16, 256), (4096, 2), (16, 3)])
def test_blocks_and_tiles_do_not_change_results(spark, rare_terms, monkeypatch, terms, sources):
    rows = made(random.Random(4), 300)
    monkeypatch.setattr(dv, "BLOCK_TERMS", terms)
    monkeypatch.setattr(dv, "TILE_SOURCES", sources)
    assert found(documents(spark, rows)) == plain(rows, 3)


def test_chunks_do_not_change_results(spark, rare_terms, monkeypatch):
    rows = made(random.Random(6), 200)
    monkeypatch.setattr(dv, "CHUNK_BYTES", 300)
    assert found(documents(spark, rows)) == plain(rows, 3)


def test_awkward_rows(spark, monkeypatch):
    table = documents(spark)
    rows = [tuple(r) for r in table.select("doc_id", "text", "lang", "source").collect()]
    for least in (1, 2, 30):
        monkeypatch.setattr(dv, "LEAST_DOCUMENTS", least)
        assert found(table) == plain(rows, least)
    assert found(empty(spark)) == []


def test_groups_without_terms(spark, monkeypatch):
    rows = [(1, None, "x", "a"), (2, "12 34", "x", "b"), (3, "", None, None), (4, "one two", "y", "a"), (5, None, "y", "b")]
    monkeypatch.setattr(dv, "LEAST_DOCUMENTS", 1)
    got = found(documents(spark, rows))
    assert got == plain(rows, 1)
    assert ("x", "a", "pair", "b", 0, 1) in got


def test_terms_are_cut_and_counted_as_in_the_pattern():
    rng = random.Random(8)
    letters = "abcXYZé中\U0001f600 \x00\x7f@[`{0-\n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(60)]
    texts += ["", "q" * 40, "Q" * 40 + "r", "中" * 3000, "a" * 8, "a" * 9, "a" * 16, "a" * 17]
    groups = np.array(sorted(rng.randrange(4) for _ in texts))
    expected, holding = Counter(), Counter()
    for text, group in zip(texts, groups.tolist(), strict=True):
        terms = [t.encode() for t in TERM.findall(text.translate(LOWER))]
        expected.update((t, group) for t in terms)
        holding.update((t, group) for t in set(terms))
    got, docs = {}, {}
    for terms, group, counts, held in dv.count_terms([t.encode().lower() for t in texts], groups):
        for t, g, n, d in zip(terms, group.tolist(), counts.tolist(), held.tolist(), strict=True):
            assert (t, g) not in got
            got[t, g], docs[t, g] = n, d
    assert got == dict(expected)
    assert docs == dict(holding)


def test_packed_words_sort_as_their_terms():
    rng = random.Random(9)
    terms = [bytes(rng.choice([97, 98, 200, 255]) for _ in range(rng.randrange(1, 17))) for _ in range(500)]
    data = np.frombuffer(b" ".join(terms) + b" " * 24, dtype=np.uint8)
    begins, lengths = dv.term_places(data)
    words = [dv.packed_words(data, begins, np.minimum(lengths, 8))]
    words.append(np.where(lengths > 8, dv.packed_words(data, begins + 8, np.maximum(lengths - 8, 1)), 0).astype(np.uint64))
    order = dv.radix_order(words)
    assert [terms[i] for i in order] == sorted(terms)
    same = [i for i in range(len(terms) - 1) if terms[order[i]] == terms[order[i + 1]]]
    assert all(order[i] < order[i + 1] for i in same)
