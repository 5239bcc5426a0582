"""Packing: ids equal to those of `tokenizers`, an exact round trip, full windows."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyboard.llm import packing
from tests.llm.cases import documents, empty


def expected_ids(texts):
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [np.array([*made.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for t in texts]


def check(rows, ids_by_doc):
    """Every id in exactly one piece, sequences gapless from 0 and within the capacity."""
    sequences, covered = defaultdict(list), defaultdict(int)
    for r in rows:
        options = [ids for ids in ids_by_doc[r.doc_id] if len(ids) == r.doc_tokens]
        assert any(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for ids in options)
        assert r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        covered[r.doc_id] += r.length
    assert covered == {doc: sum(map(len, ids)) for doc, ids in ids_by_doc.items()}
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    return len(sequences)


def test_awkward_rows_round_trip(spark):
    table = documents(spark)
    given_rows = table.select("doc_id", "text").collect()
    ids = defaultdict(list)
    for r, x in zip(given_rows, expected_ids([r.text for r in given_rows]), strict=True):
        ids[r.doc_id].append(x)
    check(packing.pack(table).collect(), ids)
    assert packing.pack(empty(spark)).collect() == []


def test_whole_table_with_little_padding(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    given_rows = table.select("doc_id", "text").collect()
    ids = {r.doc_id: [x] for r, x in zip(given_rows, expected_ids([r.text for r in given_rows]), strict=True)}
    used = check(packing.pack(table).collect(), ids)
    total = sum(len(x[0]) for x in ids.values())
    assert 1 - total / (used * packing.WINDOW) < 0.02


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_windows_hold_every_piece_once(sizes):
    found = packing.windows(sizes, 100)
    assert sorted(i for members in found for i in members) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in members) <= 100 for members in found)


def test_differencing_balances():
    # The textbook case: 8 7 6 5 4 in two ways differ by 2.
    assert [load for load, _ in packing.differencing([8, 7, 6, 5, 4], 2)] == [16, 14]
    loads = [load for load, _ in packing.differencing(list(range(1, 301)), 10)]
    assert max(loads) - min(loads) <= 2 and sum(loads) == 300 * 301 // 2
