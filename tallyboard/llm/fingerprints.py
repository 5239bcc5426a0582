"""Document fingerprints: the phrases of a Lempel-Ziv parse, hashed, and the least hashes kept.

A text is cut into symbols (runs of at most eight bytes without white space, with the white space
after them). Parsing takes the shortest phrase not met before and adds it to the phrase set. The
fingerprint is the `SIZE` least mixed phrase hashes, as hexadecimal text. The likeness of two
fingerprints estimates the Jaccard likeness of the phrase sets, so texts that would help to compress
each other are close.

Defined cases: a null or empty text has the empty fingerprint; two empty fingerprints have likeness
1, an empty and another one 0. Rows with the same doc_id are ordered by their text; a null doc_id
comes last in descending order. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import prepare, texts_of
from tallyboard.session import shuffle_width

SIZE = 128
SYMBOL = re.compile(rb"[^\x20\x09-\x0d]{1,8}[\x20\x09-\x0d]*|[\x20\x09-\x0d]+")
RANGES_PER_PARTITION = 4
NO_ID = -(2**63)

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def parse(symbols: list[bytes], phrases: set[int]) -> None:
    """Add the phrases that a parse of these symbols meets. A phrase is kept as its CRC-32."""
    crc, add, state = zlib.crc32, phrases.add, 0
    for symbol in symbols:
        state = crc(symbol, state)
        if state not in phrases:
            add(state)
            state = 0


def least(phrases: set[int]) -> np.ndarray:
    """The least `SIZE` of the mixed phrase hashes, ascending."""
    h = np.fromiter(phrases, dtype=np.uint32, count=len(phrases))
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h ^= h >> np.uint32(shift)
        h *= np.uint32(factor)
    if len(h) > SIZE:
        h = np.partition(h, SIZE - 1)[:SIZE]
    h.sort()
    return h


def fingerprint(text: str | None) -> np.ndarray:
    phrases: set[int] = set()
    parse(SYMBOL.findall((text or "").encode("utf-8", "replace")), phrases)
    return least(phrases)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Of the least hashes of both sets together, the share that both have."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:SIZE]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(both, union[-1], side="right")) / len(union)


def written(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def edit(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as much of the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_ranges(documents: DataFrame) -> DataFrame:
    """Documents in ranges of doc_id, sorted descending, each range ending with the row that follows it.

    The bounds come from Spark's quantile sketch, as many as shuffle partitions call for, so a range
    holds an even part of the rows. The largest document of a range goes to the range above as well
    (and the largest of all to the lowest), marked as helper; so a text is shuffled once.
    """
    docs = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    width = shuffle_width(documents.sparkSession)
    ranges = RANGES_PER_PARTITION * width
    shares = [i / ranges for i in range(1, ranges)]
    edges = np.array(sorted({int(x) for x in docs.approxQuantile("doc_id", shares, 0.2 / ranges)}), dtype=np.int64)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(dtype=np.int64), side="right").astype(np.int32))

    tops = docs.select("doc_id", place("doc_id").alias("part")).groupBy("part").agg(F.max("doc_id").alias("top"))
    found = sorted((row.part, row.top) for row in tops.collect())  # one row per range
    above = {part: found[(i + 1) % len(found)][0] for i, (part, _) in enumerate(found)}
    top = dict(found)

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        """The range of a row and, below zero, the range it helps."""
        values = ids.to_numpy(dtype=np.int64)
        parts = np.searchsorted(edges, values, side="right")
        return pd.Series([[p] if top[p] != v else [p, -1 - above[p]] for p, v in zip(parts, values, strict=True)])

    dealt = docs.withColumn("to", F.explode(places("doc_id")))
    part = F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to"))
    return (
        dealt.select(part.alias("part"), (F.col("to") < 0).alias("helper"), "doc_id", "text")
        .repartition(width, "part")
        .sortWithinPartitions("part", "helper", F.col("doc_id").desc(), "text")
    )


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how like they are."""
    prepare(documents.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row that waits for the one that follows it
        for batch in batches:
            rows = []
            columns = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())
            for part, helper, doc, text in zip(*columns, texts_of(batch), strict=True):
                own = fingerprint(text)
                if last and last[0] == part:
                    rows.append(finish(*last[1:], text, own))
                last = None if helper else (part, doc, text, own)
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                       "near_next"],
            )

    def finish(doc: int, text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
        changed = edit(text, following)
        print_of = fingerprint(changed)
        return (
            None if doc == NO_ID else doc,
            len(text),
            hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
            written(own),
            written(print_of),
            likeness(own, print_of),
            likeness(own, other),
        )

    return in_ranges(documents).mapInArrow(compare, RESULT)
