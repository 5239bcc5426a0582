"""Centroid clustering of embeddings, exact in integers, with a PCA-rotated filter.

A vector counts if it has `DIMENSIONS` components, none null and all finite. Each component x becomes the
integer floor(64 * x). The first centroids are the `CLUSTERS` vectors with the least sha256 of `1:<vec_id>`.
In each of `ROUNDS` rounds every vector goes to the nearest centroid (ties: the smaller number) and every
centroid that has vectors becomes the floor of their mean, component by component.

1. The principal axes of all vectors are found from their second moments, summed on the executors.
2. Every vector is rotated onto them once. Its `LEADING` first coordinates and the norm of the rest are
   written beside it. As a rotation keeps distances, and by the triangle inequality in the other
   coordinates, (distance of the leading coordinates)^2 + (difference of the residual norms)^2 is no more
   than the squared distance to a centroid.
3. An assignment works out these bounds, takes the exact distance to the centroid with the least bound, and
   verifies in integers only those centroids whose bound (less a margin for rounding) does not exceed it.
   So the rotation decides how much is verified, never the result.

The driver sees sums per cluster and component (whatever the number of vectors) and the centroids.

Defined cases: null, short, long or non-finite vectors are left out, with their rows (in a table of doubles,
2^128 and beyond is not finite either); a null vec_id is the
empty text in the hash; of equal hashes the vector that is less, component by component, comes first; repeated
rows count each; with fewer vectors than clusters each is a centroid; integers of any size are exact, and a
distance or sum that a long cannot hold is null. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import prepare, stage

DIMENSIONS, SCALE = 64, 64
CLUSTERS, ROUNDS, LEADING = 16, 3, 16
# Below this, squared distances and the sums of a task fit 64 bits.
NARROW = 2**25
# Rounding of the bounds, as a share of the squared norms; that of the 64 products is about 1e-14.
MARGIN = 1e-9
# Sums travel as numbers of 40 bits, the last one signed.
LIMBS, LIMB_BITS = 5, 40
LARGEST = 2**63 - 1
# Just above the largest number of single precision; sums of such components fit the limbs.
LARGEST_COMPONENT = 2.0**128


def sound(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that count."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST_COMPONENT))
    kept = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return kept.where((F.size("embedding") == DIMENSIONS) & F.coalesce(finite, F.lit(False)))


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as whole numbers, in doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * values.reshape(-1, DIMENSIONS))


def whole(rows: np.ndarray) -> np.ndarray:
    """Whole doubles as integers: 64 bits where these suffice, else Python's."""
    if not rows.size or np.abs(rows).max() < NARROW:
        return rows.astype(np.int64)
    return np.array([[int(x) for x in row] for row in rows], dtype=object)


def axes(vectors: DataFrame) -> np.ndarray:
    """The principal axes of all vectors, as columns, by falling variance."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros((DIMENSIONS + 1, DIMENSIONS))
        for batch in batches:
            rows = matrix(batch.column(0))
            count += len(rows)
            with np.errstate(over="ignore", invalid="ignore"):
                total[:DIMENSIONS] += rows.T @ rows
            total[DIMENSIONS] += rows.sum(axis=0)
        places = pa.array(range(DIMENSIONS + 1), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [places, pa.array([count] * (DIMENSIONS + 1), pa.int64()), pa.array(total.tolist(), pa.list_(pa.float64()))],
            names=["place", "n", "sums"],
        )

    parts = vectors.select("embedding").mapInArrow(moments, "place int, n long, sums array<double>")
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(DIMENSIONS)]
    rows = sorted(parts.groupBy("place").agg(F.sum("n").alias("n"), *sums).collect())
    if not rows or not rows[0].n:
        return np.eye(DIMENSIONS)
    table = np.array([row[2:] for row in rows], dtype=np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        mean = table[DIMENSIONS] / rows[0].n
        covariance = table[:DIMENSIONS] / rows[0].n - np.outer(mean, mean)
    if not np.isfinite(covariance).all():
        return np.eye(DIMENSIONS)
    return np.linalg.eigh((covariance + covariance.T) / 2)[1][:, ::-1]


def rotate(rows: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and norm of the rest."""
    with np.errstate(over="ignore", invalid="ignore"):
        turned = rows @ turn
        return turned[:, :LEADING], np.sqrt((turned[:, LEADING:] ** 2).sum(axis=1))


def rotated(vectors: DataFrame, turn: np.ndarray) -> DataFrame:
    """The vectors with their leading coordinates and residual norms, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, rest = rotate(matrix(batch.column(1)), turn)
            columns = [pa.array(lead.tolist(), pa.list_(pa.float64())), pa.array(rest)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["vec_id", "embedding", "lead", "rest"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return stage(vectors.mapInArrow(run, f"vec_id {kind}, embedding array<double>, lead array<double>, rest double"), "rotated")


def nearest(rows, lead, rest, centroids: list[list[int]], turn) -> tuple[np.ndarray, np.ndarray, int]:
    """For every row: the number of the nearest centroid, the squared distance, and how many distances were taken."""
    points = np.array(centroids, dtype=object).astype(np.float64)
    near, far = rotate(points, turn)
    exact, marks = whole(rows), whole(points)
    if exact.dtype != marks.dtype or max(abs(x) for c in centroids for x in c) >= NARROW:
        exact = exact.astype(object)
        marks = np.array(centroids, dtype=object)
    with np.errstate(over="ignore", invalid="ignore"):
        bounds = ((lead[:, None, :] - near[None]) ** 2).sum(axis=2) + (rest[:, None] - far[None]) ** 2
        size = (lead**2).sum(axis=1) + rest**2
        bounds -= MARGIN * (size[:, None] + ((near**2).sum(axis=1) + far**2)[None] + 1)
    guess = np.argmin(bounds, axis=1)
    best = ((exact - marks[guess]) ** 2).sum(axis=1)
    # What cannot be compared (numbers out of the doubles' range) is verified.
    alive = ~(bounds > best.astype(np.float64)[:, None])
    taken = np.full(len(rows), -1)
    least = best.copy()
    for number in range(len(centroids)):
        some = np.flatnonzero(alive[:, number] | (guess == number))
        distances = ((exact[some] - marks[number]) ** 2).sum(axis=1)
        better = (distances < least[some]) | ((distances == least[some]) & (taken[some] < 0))
        taken[some[better]], least[some[better]] = number, distances[better]
    return taken, least, int(alive.sum()) + len(rows)


def limbs(total: int) -> list[int]:
    low = [(total >> (LIMB_BITS * i)) & (2**LIMB_BITS - 1) for i in range(LIMBS - 1)]
    return [*low, total >> (LIMB_BITS * (LIMBS - 1))]


def means(table: DataFrame, centroids: list[list[int]], turn: np.ndarray) -> list[list[int]]:
    """The centroids after one round. A task sends one row per cluster and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = [0] * len(centroids), {}
        for batch in batches:
            rows, lead, rest = _columns(batch, 0)
            taken, _, _ = nearest(rows, lead, rest, centroids, turn)
            exact = whole(rows)
            for number in np.unique(taken).tolist():
                own = exact[taken == number]
                sums = own.sum(axis=0).tolist()
                counts[number] += len(own)
                totals[number] = [a + b for a, b in zip(totals.get(number, [0] * DIMENSIONS), sums, strict=True)]
        rows = [(c, j, counts[c], *limbs(x)) for c, sums in totals.items() for j, x in enumerate(sums)]
        kinds = [pa.int32(), pa.int32(), *[pa.int64()] * (1 + LIMBS)]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "place", "n", *[f"l{i}" for i in range(LIMBS)]])

    schema = "cluster int, place int, n long, " + ", ".join(f"l{i} long" for i in range(LIMBS))
    parts = table.select("embedding", "lead", "rest").mapInArrow(run, schema)
    summed = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), *[F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS)])
    after = [list(c) for c in centroids]
    for row in summed.collect():
        after[row.cluster][row.place] = sum(row[f"l{i}"] << (LIMB_BITS * i) for i in range(LIMBS)) // row.n
    return after


def _columns(batch: pa.RecordBatch, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lead = batch.column(first + 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, LEADING)
    return matrix(batch.column(first)), lead, batch.column(first + 2).to_numpy(zero_copy_only=False)


def assigned(table: DataFrame, centroids: list[list[int]], turn: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken, least, _ = nearest(*_columns(batch, 1), centroids, turn)
            distances = [x if x <= LARGEST else None for x in least.tolist()]
            columns = [batch.column(0), pa.array(taken, pa.int32()), pa.array(distances, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    kind = table.schema["vec_id"].dataType.simpleString()
    return table.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def first_centroids(vectors: DataFrame) -> list[list[int]]:
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "embedding").orderBy("key", "embedding").limit(CLUSTERS).collect()
    return [[int(np.floor(SCALE * x)) for x in row.embedding] for row in sorted(rows, key=lambda r: (r.key, r.embedding))]


def cluster(embeddings: DataFrame) -> DataFrame:
    """One row per vector that counts: cluster, squared distance, inertia of its cluster and of all, hash of its centroid."""
    spark = prepare(embeddings.sparkSession)
    vectors = sound(embeddings)
    centroids = first_centroids(vectors)
    turn = axes(vectors)
    table = rotated(vectors, turn)
    if centroids:
        for _ in range(ROUNDS):
            centroids = means(table, centroids, turn)
        rows = stage(assigned(table, centroids, turn), "assigned")
    else:
        rows = table.select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
    held = F.sum(F.col("distance").cast("decimal(38,0)"))
    of = {r.cluster: None if r.lost else int(r.total) for r in rows.groupBy("cluster").agg(held.alias("total"), F.count_if(F.col("distance").isNull()).alias("lost")).collect()}
    total = None if None in of.values() else sum(of.values())
    short = lambda x: x if x is not None and x <= LARGEST else None
    names = [
        (c, short(of.get(c)), short(total), hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
        for c, centroid in enumerate(centroids)
    ]
    sums = spark.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(sums, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
