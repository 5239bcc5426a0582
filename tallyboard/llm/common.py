"""Reading, staging and vectorised word hashing shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyboard.session import staging_folder, tune

# Rows that travel to a Python worker at once. Long texts stay within a worker's memory.
ROWS_PER_BATCH = 512
# Bytes of text that are hashed at once; a longer text is taken alone.
BYTES_PER_STEP = 2_000_000

# Bytes 9 to 13 and 32 separate words.
WHITE = np.zeros(256, dtype=bool)
WHITE[9:14] = True
WHITE[32] = True
# All ASCII bytes but letters and digits separate terms.
NOT_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])

_RANDOM = np.random.RandomState(20240611)
_BYTE_CODES = _RANDOM.randint(0, 2**63 - 1, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as package:
        for file in sorted(root.rglob("*.py")):
            package.write(file, file.relative_to(root.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings these operators rely on, and their code on the workers."""
    tune(spark)
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the folder of `spark.checkpoint.dir`, or else the warehouse."""
    return staging_folder(spark) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/staged"


def stage(table: DataFrame, name: str, *partitions: str) -> DataFrame:
    """The table, written once to the shared folder and read back."""
    spark = table.sparkSession
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = table.write
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(folder)
    staged = spark.read.schema(table.schema).parquet(folder)
    staged.staged_in = folder
    return staged


def release(*tables: DataFrame) -> None:
    """Remove tables that `stage` wrote and that nothing will read again."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(table.staged_in)
        place.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly over the whole range (a fixed bijection)."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def text_steps(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as bytes, ASCII letters in lower case, in steps of bounded size: (first row, texts)."""
    first, size, step = 0, 0, []
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "replace").lower()
        if step and size + len(raw) > BYTES_PER_STEP:
            yield first, step
            first, size, step = i, 0, []
        step.append(raw)
        size += len(raw)
    if step:
        yield first, step


def word_hashes(texts: list[bytes], separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, and where each text's words begin (one more entry)."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    text_begins = np.concatenate([[0], np.cumsum(sizes)])
    outside = separators[data]
    edge = np.flatnonzero(outside[1:] != outside[:-1]) + 1
    edge = edge if outside[0] else np.concatenate([[0], edge])
    begins, ends = edge[0::2], edge[1::2]
    starts = np.searchsorted(begins, text_begins)
    if not len(begins):
        return np.zeros(0, dtype=np.uint64), starts
    lengths = ends - begins
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, dtype=np.uint64))
    # One entry per byte of a word: its place within the word.
    total = np.cumsum(lengths)
    firsts = total - lengths
    kind = np.int32 if total[-1] < 1 << 31 else np.int64
    places = np.arange(total[-1], dtype=kind) - np.repeat(firsts.astype(kind), lengths)
    codes = _BYTE_CODES[data[~outside]]
    codes *= powers[places]
    hashes = np.add.reduceat(codes, firsts)
    return mix(hashes + lengths.astype(np.uint64)), starts


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()
