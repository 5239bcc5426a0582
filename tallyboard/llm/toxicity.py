"""Toxicity as severity grades: cumulative-link ordinal regression on sparse text features.

The grades are 0 (labelled clean) to `GRADES - 1`. Labels only say toxic or not, so the grade of a
toxic training document is 1 + how many of `STEPS` its number of distinct telling terms reaches; a
telling term is one whose presence speaks for the toxic label. One weight vector is shared by all
ordered thresholds:

    P(grade <= k) = logistic(theta_k - w x),  theta_0 < theta_1 < ...

x holds 1 + log2(count) of the hashed terms that occur (runs of letters and digits, A-Z lower-cased). Only terms whose
document shares differ clearly between the labels get a weight. The result is the expected grade,
sum over k of P(grade > k); a document is flagged if P(grade > 0) >= 0.5.

Learning uses at most `SAMPLE` labelled documents, chosen by a hash of doc_id, half of them toxic;
class weights restore the true shares. Defined cases: a null or empty text has no terms; without
both labels everything gets severity 0; conflicting labels count as toxic; labels without document
are ignored; repeated rows are scored alike; very long texts are read in full. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import NOT_ALNUM, prepare, text_steps, word_hashes

SAMPLE = 20_000
TERMS = 4096  # terms with a weight, at most
BUCKETS = 1 << 20
LEAST_Z = 6.0
LEAST_TOXIC = 5  # a telling term is in so many toxic sample documents
STEPS = (2, 4)  # distinct telling terms of grade 2 and above
GRADES = len(STEPS) + 2
RIDGE = 0.02
ROUNDS = 1000

RESULT = "doc_id long, severity double, grade int, toxic boolean, p_toxic double, terms int"


def buckets(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Steps of texts: the first row, the buckets of all terms and the step's row of each."""
    for first, step in text_steps(texts):
        words, starts = word_hashes(step, NOT_ALNUM)
        yield first, (words % np.uint64(BUCKETS)).astype(np.int64), np.repeat(np.arange(len(step)), np.diff(starts))


def distinct(found: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each bucket once per row: (rows, buckets, feature values)."""
    both, times = np.unique(rows * np.int64(BUCKETS) + found, return_counts=True)
    return both // BUCKETS, both % BUCKETS, 1 + np.log2(times)


def sample(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """(toxic, text) of the chosen documents, and how many documents have each label.

    The chosen ids are at most `most` and are broadcast.
    """
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    sizes = {int(r.toxic): r["count"] for r in marked.groupBy("toxic").count().collect()}
    picked = None
    for toxic in (0, 1):
        some = marked.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2)
        picked = some if picked is None else picked.union(some)
    return documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("toxic", "text"), sizes


@dataclass
class Model:
    weights: np.ndarray  # by bucket, 0 for most
    thresholds: np.ndarray


def choose(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Buckets with a clear difference between the labels, and which of them are telling."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, BUCKETS), dtype=np.int32)
        seen = np.zeros(2, dtype=np.int64)
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            seen += np.bincount(toxic, minlength=2)
            for first, found, at in buckets(batch.column(1).to_pylist()):
                row, bucket, _ = distinct(found, at)
                for k in (0, 1):
                    totals[k] += np.bincount(bucket[toxic[first + row] == k], minlength=BUCKETS).astype(np.int32)
        used = np.flatnonzero(totals.any(axis=0))
        keys = np.concatenate([[-1], used]) if seen.any() else used
        clean, bad = (np.concatenate([[seen[k]] if seen.any() else [], totals[k][used]]).astype(np.int64) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(clean), pa.array(bad)], names=["b", "clean", "bad"])

    counted = rows.mapInArrow(count, "b long, clean long, bad long").groupBy("b").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    counted = counted.persist()
    try:
        sizes = counted.where("b = -1").first()
        if not sizes or not sizes.clean or not sizes.bad:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
        p, q = (F.col("bad") + 0.5) / (sizes.bad + 1.0), (F.col("clean") + 0.5) / (sizes.clean + 1.0)
        both = (F.col("bad") + F.col("clean") + 1.0) / (sizes.bad + sizes.clean + 2.0)
        z = (p - q) / F.sqrt(both * (1 - both) * (1.0 / sizes.bad + 1.0 / sizes.clean))
        best = (
            counted.where("b >= 0")
            .select("b", z.alias("z"), "bad")
            .where((F.abs("z") >= LEAST_Z) & ((F.col("z") < 0) | (F.col("bad") >= LEAST_TOXIC)))
            .orderBy(F.desc(F.abs("z")), "b")
            .limit(TERMS)
            .collect()
        )
    finally:
        counted.unpersist()
    best.sort(key=lambda r: r.b)
    return np.array([r.b for r in best], dtype=np.int64), np.array([r.z > 0 for r in best], dtype=bool)


def patterns(rows: DataFrame, chosen: np.ndarray) -> list:
    """The distinct combinations of label and chosen terms, with their numbers of documents."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sets: list[list[int]] = [[] for _ in texts]
            values: list[list[float]] = [[] for _ in texts]
            for first, found, at in buckets(texts):
                place = np.minimum(np.searchsorted(chosen, found), len(chosen) - 1)
                hit = chosen[place] == found
                for row, term, value in zip(*distinct(place[hit], at[hit]), strict=True):
                    sets[first + int(row)].append(int(term))
                    values[first + int(row)].append(round(float(value), 3))
            columns = [batch.column(0), pa.array(sets, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "terms", "x"])

    reduced = rows.mapInArrow(reduce, "toxic int, terms array<int>, x array<double>")
    return reduced.groupBy("toxic", "terms", "x").count().collect()


def fit(found: list, telling: np.ndarray, shares: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds by gradient steps (Adam) on the penalised likelihood."""
    number = np.array([r["count"] * shares[int(r.toxic)] for r in found])
    rows = np.repeat(np.arange(len(found)), [len(r.terms) for r in found])
    terms = np.array([t for r in found for t in r.terms], dtype=np.int64)
    values = np.array([v for r in found for v in r.x])
    hits = np.bincount(rows, weights=telling[terms], minlength=len(found))
    toxic = np.array([int(r.toxic) for r in found])
    grade = toxic * (1 + sum((hits >= s).astype(int) for s in STEPS))
    size = len(telling)
    # The first threshold and the logarithms of the gaps between them.
    free = np.concatenate([np.zeros(size), [0.0], np.zeros(GRADES - 2)])
    mean, square, total = np.zeros_like(free), np.zeros_like(free), number.sum()
    for turn in range(1, ROUNDS + 1):
        theta = np.cumsum(np.concatenate([free[size : size + 1], np.exp(free[size + 1 :])]))
        x = np.bincount(rows, weights=free[terms] * values, minlength=len(found))
        cuts = 1 / (1 + np.exp(-np.clip(theta[None, :] - x[:, None], -30, 30)))  # P(grade <= k)
        slopes = cuts * (1 - cuts)
        full = np.concatenate([np.zeros((len(found), 1)), cuts, np.ones((len(found), 1))], axis=1)
        steep = np.concatenate([np.zeros((len(found), 1)), slopes, np.zeros((len(found), 1))], axis=1)
        at = np.arange(len(found))
        p = np.maximum(full[at, grade + 1] - full[at, grade], 1e-12)
        up, down = steep[at, grade + 1] / p * number, steep[at, grade] / p * number
        by_x = down - up
        slope = np.zeros_like(free)
        slope[:size] = np.bincount(terms, weights=by_x[rows] * values, minlength=size) - RIDGE * free[:size]
        by_theta = np.bincount(grade, weights=up, minlength=GRADES)[: GRADES - 1] - np.bincount(grade, weights=down, minlength=GRADES)[1:]
        tails = np.cumsum(by_theta[::-1])[::-1]
        slope[size] = tails[0]
        slope[size + 1 :] = tails[1:] * np.exp(free[size + 1 :])
        slope /= total
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        free += 0.1 * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-9)
    return free[:size], np.cumsum(np.concatenate([free[size : size + 1], np.exp(free[size + 1 :])]))


def learn(documents: DataFrame, labels: DataFrame) -> Model | None:
    rows, sizes = sample(documents, labels)
    if not sizes.get(0) or not sizes.get(1):
        return None
    chosen, telling = choose(rows)
    if not telling.any():
        return None
    found = patterns(rows, chosen)
    if not any(r.terms for r in found):
        return None
    drawn = {k: sum(r["count"] for r in found if int(r.toxic) == k) for k in (0, 1)}
    weights, thresholds = fit(found, telling, {k: sizes[k] / max(1, drawn[k]) for k in (0, 1)})
    table = np.zeros(BUCKETS, dtype=np.float32)
    table[chosen] = weights
    return Model(table, thresholds)


def severity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: expected severity, likeliest grade and whether it is flagged as toxic."""
    spark = prepare(documents.sparkSession)
    sent = spark.sparkContext.broadcast(learn(documents, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            x, terms = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int32)
            for first, found, at in buckets(texts) if model else ():
                hit = model.weights[found] != 0
                row, bucket, value = distinct(found[hit], at[hit])
                x += np.bincount(first + row, weights=model.weights[bucket] * value, minlength=len(texts))
                terms += np.bincount(first + row, minlength=len(texts)).astype(np.int32)
            thresholds = model.thresholds if model else np.full(GRADES - 1, 30.0)
            above = 1 - 1 / (1 + np.exp(-np.clip(thresholds[None, :] - x[:, None], -30, 30)))  # P(grade > k)
            if model is None:
                above[:] = 0
            each = -np.diff(np.concatenate([np.ones((len(x), 1)), above, np.zeros((len(x), 1))], axis=1), axis=1)
            columns = [
                pa.array(above.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(above[:, 0] >= 0.5),
                pa.array(above[:, 0]), pa.array(terms),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "severity", "grade", "toxic", "p_toxic", "terms"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)
