"""Near-duplicate documents by b-bit MinHash.

A document's set holds its distinct shingles of `size` words (A-Z lower-cased); with fewer words the
whole sequence is the one shingle. Documents are linked if 100 * intersection >= `percent` * union of
their sets; groups are the connected components of the links.

1. Every text gives `HASHES` minima. They make `BANDS` band hashes, and their low `BITS` bits are packed
   into four longs. Documents with equal sets become one class; all that follows is on classes.
2. Classes that share a band hash are candidates. In each such bucket, all are paired with the member
   that meets the most others; so a bucket of m classes gives m - 1 pairs.
3. The bits of a pair's signatures that agree, corrected for chance, estimate its likeness; pairs far
   below the limit go. The others are confirmed on their full sets.
4. Components are formed. Where a bucket still holds several, its members get signatures of `WIDE` minima,
   and those outside the component of its centre are paired with the members of other components. The
   join itself estimates a pair and leaves it to the first bucket that both share, so only likely pairs
   come out, once each; they are confirmed. So every candidate pair is either confirmed, refuted or
   inside one component already: no link that the bands find is lost, and copies are never expanded
   into all pairs.

With 32 bands of 4 minima, a pair at the limit of 0.8 shares no band with probability 5e-8.

Defined cases: a text without words (or null) has the empty set and is linked with nothing. Repeated
rows are copies of each other; a null doc_id counts as the largest; very long texts are read in full.
Extra columns are ignored by `near_duplicates` and kept by `keep_first`. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.llm.common import mix, prepare, stage, text_steps, word_hashes
from tallyboard.llm.components import components

HASHES, BANDS, BITS = 128, 32, 2
LANES = HASHES * BITS // 64
WIDE = 1024
WIDE_LANES = WIDE * BITS // 64
NO_ID = 2**63 - 1
# Signatures of two sets with likeness 0.8 agree in fewer places with probability 2e-8 (5.5 deviations).
DEVIATIONS = 5.5

_RANDOM = np.random.RandomState(77)
_FACTORS = (_RANDOM.randint(0, 2**63 - 1, WIDE).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_SHIFTS = _RANDOM.randint(0, 2**63 - 1, WIDE).astype(np.uint64)
_PLACE = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                                 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93)]


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the distinct shingles of a text's word hashes, ascending."""
    if not len(words):
        return words
    if len(words) < size:
        total = np.uint64(len(words))
        for i, w in enumerate(words.tolist()):
            total = mix(np.array([total ^ np.uint64(w)]) + _PLACE[i % len(_PLACE)])[0]
        return np.array([total], dtype=np.uint64)
    count = len(words) - size + 1
    total = np.zeros(count, dtype=np.uint64)
    for i in range(size):
        total += words[i : i + count] * (_PLACE[i % len(_PLACE)] | np.uint64(1))
    return np.unique(mix(total))


def sets_of(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    for _, step in text_steps(texts):
        words, starts = word_hashes(step)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield shingle_set(words[a:b], size)


def minima(members: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    best = np.full(hashes, np.iinfo(np.uint64).max, dtype=np.uint64)
    factors, shifts = _FACTORS[:hashes, None], _SHIFTS[:hashes, None]
    for i in range(0, len(members), 2048):
        part = members[i : i + 2048]
        np.minimum(best, (part[None, :] * factors + shifts).min(axis=1), out=best)
    return best >> np.uint64(20)


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, 64 / `BITS` of them in a long."""
    low = (least & np.uint64((1 << BITS) - 1)).reshape(len(least) * BITS // 64, -1)
    places = np.arange(low.shape[1], dtype=np.uint64) * np.uint64(BITS)
    return (low << places).sum(axis=1, dtype=np.uint64).view(np.int64)


def band_hashes(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, -1)
    total = np.arange(1, BANDS + 1, dtype=np.uint64) * _PLACE[0]
    for i in range(rows.shape[1]):
        total = mix(total ^ rows[:, i] * (_PLACE[i + 1] | np.uint64(1)))
    return total.view(np.int64)


SPACES = " \t\n\x0b\f\r"  # what stands between words


def row_id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def sketches(documents: DataFrame, size: int) -> DataFrame:
    """One row per document: id, hash of the text, set size, hash of the set, signature and band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, lanes, bands = [], [], [], []
            for members in sets_of(batch.column(2).to_pylist(), size):
                least = minima(members)
                sizes.append(len(members))
                keys.append(int(mix(np.array([members.sum(dtype=np.uint64) + np.uint64(len(members))])).view(np.int64)[0]))
                lanes.append(packed(least))
                bands.append(band_hashes(least) if len(members) else [])
            columns = [pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())]
            columns += [pa.array([x[i] for x in lanes], pa.int64()) for i in range(LANES)]
            names = ["id", "h", "n", "key", *[f"s{i}" for i in range(LANES)], "bands"]
            arrays = [batch.column(0), batch.column(1), *columns, pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "id long, h long, n long, key long, " + ", ".join(f"s{i} long" for i in range(LANES)) + ", bands array<long>"
    rows = documents.select(row_id(F.col("doc_id")).alias("id"), F.xxhash64("text").alias("h"), "text")
    return rows.mapInArrow(run, schema)


def agreeing(a: str, b: str, sign: str = "s", lanes: int = LANES) -> Column:
    """In how many places the packed signatures of two sides agree."""
    lanes = [F.bitwise_not(F.col(f"{a}.{sign}{i}").bitwiseXOR(F.col(f"{b}.{sign}{i}"))) for i in range(lanes)]
    low = F.lit(0x5555555555555555)
    return reduce(lambda x, y: x + y, [F.bit_count(x.bitwiseAND(F.shiftright(x, 1)).bitwiseAND(low)) for x in lanes])


def least_agreeing(percent: int, hashes: int = HASHES) -> int:
    """Places that must agree: chance makes 2^-b of the others agree, and estimates scatter."""
    share = percent / 100 + (1 - percent / 100) / 2**BITS
    return int(hashes * share - DEVIATIONS * (hashes * share * (1 - share)) ** 0.5)


def wide_signatures(texts: DataFrame, size: int) -> DataFrame:
    """(key, w0, w1, ...) of the classes whose texts (key, text) are given."""
    names = [f"w{i}" for i in range(WIDE_LANES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [packed(minima(members, WIDE)) for members in sets_of(batch.column(1).to_pylist(), size)]
            lanes = [pa.array([r[i] for r in rows], pa.int64()) for i in range(WIDE_LANES)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lanes], names=["key", *names])

    return texts.select("key", "text").mapInArrow(run, "key long, " + ", ".join(f"{n} long" for n in names))


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (u, v) of classes whose full sets are alike enough."""
    left = texts.select(F.col("key").alias("u"), F.col("text").alias("left"))
    right = texts.select(F.col("key").alias("v"), F.col("text").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            sides = [list(_once(batch.column(i).to_pylist(), size)) for i in (2, 3)]
            for a, b in zip(*sides, strict=True):
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "left", "right")
    return joined.mapInArrow(run, "u long, v long")


def _once(texts: list[str], size: int) -> Iterator[np.ndarray]:
    """Sets of the texts; a text that follows itself is read once."""
    fresh = [t for i, t in enumerate(texts) if not i or t != texts[i - 1]]
    made, now = sets_of(fresh, size), None
    for i, text in enumerate(texts):
        if not i or text != texts[i - 1]:
            now = next(made)
        yield now


def groups(documents: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(sketches of all rows without bands, component and least row of every class)."""
    every = stage(sketches(documents, size), "sketches")
    lanes = [f"s{i}" for i in range(LANES)]
    classes = stage(
        every.where("n > 0")
        .groupBy("key")
        .agg(F.min(F.struct("id", "h")).alias("first"), *[F.first(x).alias(x) for x in [*lanes, "bands"]]),
        "classes",
    )
    spread = classes.select("key", F.explode("bands").alias("bucket"))
    sizes = spread.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = stage(spread.join(sizes, "bucket"), "buckets")
    degree = shared.groupBy("key").agg(F.sum("size").alias("degree"))
    members = stage(shared.join(degree, "key").select("bucket", "key", "degree"), "members")
    wanted = members.select("key").distinct().join(classes.select("key", "first"), "key")
    texts = stage(
        documents.select(row_id(F.col("doc_id")).alias("id"), F.xxhash64("text").alias("h"), "text")
        .join(wanted.select("key", F.col("first.id").alias("id"), F.col("first.h").alias("h")), ["id", "h"])
        .dropDuplicates(["key"])
        .select("key", "text"),
        "candidate_texts",
    )
    centres = members.groupBy("bucket").agg(F.max(F.struct("degree", "key")).getField("key").alias("centre"))
    signs = classes.select("key", *lanes)
    stars = (
        members.join(centres, "bucket")
        .where("key <> centre")
        .groupBy(F.col("key").alias("u"), F.col("centre").alias("v"))
        .agg(F.lit(1).alias("one"))
    )
    near = agreeing("a", "b") >= least_agreeing(percent)
    likely = (
        stars.join(signs.withColumnRenamed("key", "u").alias("a"), "u")
        .join(signs.withColumnRenamed("key", "v").alias("b"), "v")
        .where(near)
        .select("u", "v")
    )
    links = stage(confirmed(likely, texts, size, percent), "confirmed")
    parts = components(links)

    # Buckets whose members are not yet all connected.
    label = F.coalesce("v", "key").alias("label")
    named = members.join(parts, F.col("key") == F.col("u"), "left").select("bucket", "key", label)
    split = named.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("bucket")
    unsettled = stage(named.join(split, "bucket").join(centres, "bucket"), "unsettled")
    signed = wide_signatures(texts.join(unsettled.select("key").distinct(), "key"), size)
    signed = stage(signed.join(classes.select("key", "bands"), "key"), "wide_signatures")
    main = unsettled.where("key = centre").select("bucket", F.col("label").alias("main"))
    sides = unsettled.join(main, "bucket").join(signed, "key").withColumn("outside", F.col("label") != F.col("main"))
    closer = agreeing("a", "b", "w", WIDE_LANES) >= least_agreeing(percent, WIDE)
    once = F.element_at(F.array_intersect("a.bands", "b.bands"), 1) == F.col("a.bucket")
    rest = (
        sides.where("outside")
        .alias("a")
        .join(
            sides.where("key <> centre").alias("b"),
            (F.col("a.bucket") == F.col("b.bucket"))
            & (F.col("a.label") != F.col("b.label"))
            & (~F.col("b.outside") | (F.col("a.key") < F.col("b.key")))
            & closer
            & once,
        )
        .groupBy(F.least("a.key", "b.key").alias("u"), F.greatest("a.key", "b.key").alias("v"))
        .agg(F.lit(1).alias("one"))
    )
    more = stage(confirmed(rest, texts, size, percent), "confirmed")
    if not more.isEmpty():
        parts = components(links.union(more))
    named = classes.join(parts, F.col("key") == F.col("u"), "left").select("key", "first", label)
    heads = named.groupBy("label").agg(F.min("first").alias("head"))
    return every.select("id", "h", "n", "key"), named.join(heads, "label").select("key", "head")


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: set size, the least doc_id of its group and whether that is its own."""
    prepare(documents.sparkSession)
    every, heads = groups(documents, size, percent)
    found = every.join(heads, "key", "left")
    head = F.when(F.col("n") > 0, F.col("head.id")).otherwise(F.col("id"))
    real = lambda c: F.when(c != NO_ID, c)
    return found.select(
        real(F.col("id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        real(head).alias("component_id"),
        (F.col("id") == head).alias("kept"),
    )


def keep_first(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns as they are, one of each group: that with the least doc_id.

    Rows with equal doc_id and text are one document, and of them the row stays whose other columns have the
    least hash. Rows without words all stay.
    """
    prepare(documents.sparkSession)
    every, heads = groups(documents, size, percent)
    out = every.where("n > 0").join(heads, "key").where("id <> head.id or h <> head.h").select("id", "h").distinct()
    others = F.struct(*[c for c in documents.columns if c != "text"])
    wordless = F.btrim(F.coalesce("text", F.lit("")), F.lit(SPACES)) == ""
    whole = documents.select(
        F.struct("*").alias("row"),
        row_id(F.col("doc_id")).alias("id"),
        F.xxhash64("text").alias("h"),
        F.xxhash64(F.to_json(others)).alias("rest"),
        # Rows without words, which may be many, are groups of one row each.
        F.when(wordless, F.monotonically_increasing_id()).alias("own"),
    )
    order = Window.partitionBy("id", "h", "own").orderBy("rest")
    stays = whole.join(out, ["id", "h"], "left_anti").withColumn("nth", F.row_number().over(order))
    return stays.where("nth = 1").select("row.*")
