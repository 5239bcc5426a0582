"""Packing of documents into training windows by Karmarkar-Karp multiway differencing.

Every text is tokenized, closed with `CLOSE`, and cut: as many full windows as it holds, then pieces of
at most `PIECE` ids. A full window is a sequence by itself. The other pieces are dealt into blocks, and
a block is divided into as few windows as its tokens need: each piece begins as a partition with one
used window; the two partitions with the largest imbalance are merged, the fullest windows of one with
the emptiest of the other, until one is left. If a window exceeds the capacity, the division is
repeated with more windows.

The ids are those of the `tokenizers` file `byte_bpe_50k.json`; they are made by `tiktoken` from the
same vocabulary, which gives equal ids several times faster (a test compares both). Texts never leave
their task: only piece lengths and checksums are shuffled.

Defined cases: a null or empty text is the closing id alone. Repeated rows are packed each. Very long
texts are read in full. The string of the end-of-text token counts as that token, as in `tokenizers`.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import prepare, stage

WINDOW = 2048
PIECE = 512
CLOSE = 1
BLOCK = 4000  # pieces that are divided together
PIECES_PER_TASK = 20_000
MORE = 0.002  # windows added when one is too full, as a share

RESULT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level tokenizer of a file of ranks."""
    import public_tokenizers

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = {"<|endoftext|>": len(ranks)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(text: str | None, path: str) -> np.ndarray:
    """The ids of a text, with the closing id."""
    found = encoder(path).encode(text or "", allowed_special="all")
    return np.array([*found, CLOSE], dtype="<u4")


def cuts(total: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    full = total // WINDOW * WINDOW
    for start in range(0, full, WINDOW):
        yield start, WINDOW
    for start in range(full, total, PIECE):
        yield start, min(PIECE, total - start)


def pieces(documents: DataFrame, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = token_ids(text, path)
                for start, length in cuts(len(ids)):
                    rows.append((doc, start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def differencing(sizes: list[int], ways: int) -> list[tuple[int, list[int]]]:
    """A division into `ways` windows, fullest first: (load, members). Unused windows are left out."""
    heap = [(-size, i, [(size, [i])]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = max(0, len(a) + len(b) - ways)  # windows that both partitions use
        merged = a[: len(a) - both] + b[: len(b) - both]
        for x, y in zip(a[len(a) - both :], reversed(b[len(b) - both :]), strict=True):
            merged.append((x[0] + y[0], x[1] + y[1]))
        merged.sort(key=lambda window: -window[0])
        least = merged[-1][0] if len(merged) == ways else 0
        heapq.heappush(heap, (least - merged[0][0], number, merged))
        number += 1
    return heap[0][2] if heap else []


def windows(sizes: list[int], capacity: int = WINDOW) -> list[list[int]]:
    """The members of the windows: as few windows as the method fits into the capacity."""
    ways = -(-sum(sizes) // capacity)
    while True:
        found = differencing(sizes, ways)
        if not found or found[0][0] <= capacity:
            return [members for _, members in found]
        ways += max(1, int(ways * MORE))


def pack(documents: DataFrame, path: str | None = None) -> DataFrame:
    """One row per piece, with its sequence and its place there."""
    prepare(documents.sparkSession)
    cut = stage(pieces(documents, path or vocabulary()), "pieces")
    alone = cut.where(F.col("length") == WINDOW).select(
        "*", (2 * F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = cut.where(F.col("length") < WINDOW)
    tasks = max(1, rest.count() // PIECES_PER_TASK)

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Odd numbers; a task counts on from its own first one.
        number = (TaskContext.get().partitionId() << 34) + 1
        held: list[pa.RecordBatch] = []
        for batch in _ended(batches):
            if batch is not None:
                held.append(batch)
            waiting = sum(len(x) for x in held)
            while waiting >= BLOCK or (batch is None and waiting):
                table = pa.Table.from_batches(held)
                block, table = table.slice(0, BLOCK), table.slice(BLOCK)
                held, waiting = table.to_batches(), len(table)
                sizes = block.column("length").to_pylist()
                order, numbers, offsets = [], [], []
                for members in windows(sizes):
                    at = 0
                    for i in members:
                        order.append(i)
                        numbers.append(number)
                        offsets.append(at)
                        at += sizes[i]
                    number += 2
                out = block.take(pa.array(order, pa.int64())).combine_chunks()
                out = out.append_column("sequence_id", pa.array(numbers, pa.int64()))
                yield from out.append_column("offset", pa.array(offsets, pa.int64())).to_batches()

    dealt = rest.repartition(tasks, F.xxhash64("doc_id", "start", "ids_crc32"))
    return alone.unionByName(dealt.mapInArrow(divide, RESULT))


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None
