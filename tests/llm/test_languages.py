"""Language filters: no n-gram is missed, held-out accuracy, awkward rows."""

import zlib
from collections import Counter

import numpy as np

from tallyboard.llm import languages
from tests.llm.cases import documents, empty


def plain_grams(text):
    """The n-grams of a text, cut out one by one."""
    letters = "".join(c if c.isalpha() else "\0" for c in (text or "").lower() + "\n")
    padded = "\0" + letters + "\0\0\0"
    found = []
    for i in range(len(letters)):
        a, b, d, e = padded[i : i + 4]
        if b != "\0" and (d != "\0" or a == "\0"):
            found.append((a, b, d, e if d != "\0" else "\0"))
    return found


def test_grams_are_those_cut_out_one_by_one():
    texts = ["The cat a sat.", None, "", "Ünïté 12 x", "a b"]
    hashes, begins = languages.grams(texts)
    for i, text in enumerate(texts):
        own = hashes[begins[i] : begins[i + 1]]
        expected = plain_grams(text)
        assert len(own) == len(expected)
        assert len(set(own.tolist())) == len(set(expected))


def test_held_out_documents_are_recognised(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in table.select("doc_id", "lang").collect()}
    rows = languages.identify(table).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    tested = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in tested]) > 0.98


def test_decisions_equal_those_of_exact_sets(spark):
    """Sets in place of filters: the same languages, and shares that differ by what chance leaves only."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    own = {r.doc_id: Counter(plain_grams(r.text)) for r in rows}
    counts = {}
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 5:
            counts.setdefault(r.lang, Counter()).update(own[r.doc_id])
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    sets = {}
    for lang, c in counts.items():
        best = {g: max(other[g] / totals[x] for x, other in counts.items()) for g in c}
        sets[lang] = {g for g, n in c.items() if n >= languages.LEAST_COUNT and n / totals[lang] >= languages.LEAST_RATE * best[g]}
    assert max(map(len, sets.values())) <= languages.GRAMS
    table = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in languages.identify(table).collect()}
    for doc_id, grams in own.items():
        hits = {lang: sum(n for g, n in grams.items() if g in known) for lang, known in sorted(sets.items())}
        total, best = sum(hits.values()), max(hits, key=hits.get)
        r = found[doc_id]
        assert r.lang_pred == best
        assert abs(r.score - hits[best] / total) < 0.03
        assert abs(r.known - hits[best] / sum(grams.values())) < 0.03


def test_a_learned_gram_is_never_missed(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = languages.learn(table)
    counts = {}
    for r in table.collect():
        counts.setdefault(r.lang, Counter()).update(languages.grams([r.text])[0].tolist())
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    for i, lang in enumerate(model.languages):
        most = [g for g, n in counts[lang].most_common(50) if all(
            n / totals[lang] >= c[g] / totals[x] for x, c in counts.items())]
        masks = np.full(len(most), 255)
        for slots in model.slots(np.array(most, dtype=np.uint64)):
            masks &= model.table[slots]
        assert ((masks >> i) & 1).all()


def test_awkward_rows(spark):
    rows = languages.identify(documents(spark)).collect()
    assert len(rows) == 15
    by_id = {r.doc_id: r for r in rows if r.doc_id in {3, 4, 5, 6}}
    assert all(r.lang_pred == "und" and r.score == 0 for r in by_id.values())
    assert {r.lang_pred for r in rows} <= {"und", "de", "en"}
    assert languages.identify(empty(spark)).collect() == []
    nothing = documents(spark, [(1, "Some text here", None, "a")])
    assert [r.lang_pred for r in languages.identify(nothing).collect()] == ["und"]


def test_keeping_keeps_columns_and_rows(spark):
    table = documents(spark)
    kept = languages.keep_known(table, least=0.0)
    assert kept.schema == table.schema
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 2, 7, 8, 8, 9, 10, 11]
    assert languages.keep_known(empty(spark)).count() == 0


def test_a_rare_language_is_learned_from_all_its_rows(spark):
    rows = [(i, f"the keeper wrote down the weather of morning {i}", "en", "a") for i in range(3000)]
    rows += [(9000 + i, "zvon kdysi hlasil pristav za mlhy", "cs", "a") for i in range(8)]
    model = languages.learn(documents(spark, rows), learn_from=100)
    ((code, _, known),) = languages.judge(model, ["zvon kdysi hlasil pristav za mlhy"])
    assert code == "cs" and known > 0.99
    assert languages.judge(model, ["the keeper wrote down the weather"])[0][0] == "en"


def test_more_languages_than_a_mask_has_bits(spark):
    own = [f"{a}{b}{a}{b}ka {b}{a}{a}mo" for a in "abcdefghi" for b in "klmnopqr"]
    rows = [(100 * i + k, text, f"l{i:02}", "a") for i, text in enumerate(own) for k in range(8)]
    model = languages.learn(documents(spark, rows))
    assert len(model.languages) == 72
    assert [lang for lang, _, _ in languages.judge(model, own)] == [f"l{i:02}" for i in range(72)]
