"""The pipeline on a small folder: every stage against a plain version on its own input."""

from collections import defaultdict

import pytest

import corpus_pipeline
from tallyboard.llm import languages, mixing, quality
from tallyboard.llm.common import stage
from tests.llm.cases import documents, empty, labels, words
from tests.llm.test_mixing import plain_scale
from tests.llm.test_near_duplicates import brute
from tests.llm.test_packing import check, expected_ids
from tests.llm.test_quality import counted

COLUMNS = "doc_id text lang source n_chars".split()


@pytest.fixture(scope="module")
def outputs(spark):
    """The input of every stage, and the last result."""
    folder = "/root/testdata/sf0.001"
    tables = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES:
        tables.append(stage(step(spark, tables[-1], folder), name))
    return tables


def ids(table):
    return sorted(r.doc_id for r in table.select("doc_id").collect())


def test_columns_and_rows_stay(outputs):
    for before, after in zip(outputs[:-2], outputs[1:-1], strict=True):
        assert after.columns == COLUMNS
        assert set(after.collect()) <= set(before.collect())


def test_language_stage(outputs):
    model = languages.learn(outputs[0].where(~languages.held_out(outputs[0]["doc_id"])))
    rows = outputs[0].collect()
    judged = languages.judge(model, [r.text for r in rows])
    expected = [r.doc_id for r, (lang, _, known) in zip(rows, judged, strict=True) if lang != "und" and known >= languages.KNOWN]
    assert ids(outputs[1]) == sorted(expected)
    assert len(expected) > 0.95 * len(rows)


def test_quality_stage(spark, outputs):
    rows = outputs[1].collect()
    marks = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    scores = {r.doc_id: r.score for r in quality.judge(outputs[1], marks).collect()}
    expected = []
    for r in rows:
        n, _, _, _, repeated = counted(r.text)
        if n >= 10 and 100 * repeated <= 20 * n and scores[r.doc_id] >= quality.THRESHOLD:
            expected.append(r.doc_id)
    assert ids(outputs[2]) == sorted(expected)


def test_near_copy_stage(outputs):
    groups = brute([(r.doc_id, r.text) for r in outputs[2].collect()], 5, 80)
    assert ids(outputs[3]) == sorted({int(head) for _, _, head in groups})


def test_mixing_stage(outputs):
    rows = outputs[3].collect()
    tokens = defaultdict(int)
    cell = {}
    for r in rows:
        found = words(r.text.lower())
        met = {t: len(set(found) & set(keys)) for t, keys in mixing.TOPICS.items()}
        best = max([*met.values(), 1])
        topic = next((t for t, n in met.items() if n == best), mixing.OTHER)
        cell[r.doc_id] = (r.source, r.lang, topic)
        tokens[cell[r.doc_id]] += len(found)
    weight = {c: float(n) for c, n in tokens.items()}
    sums = [defaultdict(float) for _ in range(3)]
    for c, n in tokens.items():
        for i in range(3):
            sums[i][c[i]] += n
    for _ in range(mixing.ROUNDS):
        for i in range(3):
            now = defaultdict(float)
            for c, w in weight.items():
                now[c[i]] += w
            weight = {c: w * sums[i][c[i]] ** mixing.TEMPER / now[c[i]] for c, w in weight.items()}
    import hashlib

    scale = plain_scale([(tokens[c], weight[c]) for c in weight], mixing.DRAWN)
    drawn = [
        r.doc_id
        for r in rows
        if int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:8], 16) / 2**32
        < round(min(scale * weight[cell[r.doc_id]] / tokens[cell[r.doc_id]], 1), 9)
    ]
    assert ids(outputs[4]) == sorted(drawn)


def test_packing_stage(outputs):
    rows = outputs[4].collect()
    made = {r.doc_id: [x] for r, x in zip(rows, expected_ids([r.text for r in rows]), strict=True)}
    check(outputs[5].collect(), made)


def test_run_gives_the_last_stage(spark, outputs):
    table = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, table.collect())) == sorted(map(key, outputs[5].collect()))


@pytest.mark.parametrize("rows", ["awkward", "empty"])
def test_awkward_folder(spark, tmp_path, rows):
    folder = str(tmp_path)
    (documents(spark) if rows == "awkward" else empty(spark)).write.parquet(f"{folder}/documents.parquet")
    labels(spark, [(1, 1, 0), (7, None, None), (None, 0, 1)]).write.parquet(f"{folder}/labels.parquet")
    found = corpus_pipeline.run(spark, folder).collect()
    assert not found or rows == "awkward"
    assert all(r.length > 0 for r in found)
