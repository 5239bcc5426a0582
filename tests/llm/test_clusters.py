"""Clusters against plain integers in Python; what the filter leaves to verify; awkward vectors."""

import hashlib
import math
import random

import numpy as np

from tallyboard.llm import clusters as cl

EXTRA = "cluster string, lead int, rest string, place string, n string"


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, *[None] * 5) for r in rows], f"vec_id long, embedding array<{kind}>, {EXTRA}")


def plain(rows):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid hash) by definition."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    points = [[math.floor(64 * x) for x in v] for _, v in kept]
    key = lambda r: (hashlib.sha256(f"1:{'' if kept[r][0] is None else kept[r][0]}".encode()).hexdigest(), kept[r][1])
    centroids = [points[r] for r in sorted(range(len(kept)), key=key)[:16]]

    def assign():
        found = []
        for p in points:
            far = [sum((a - b) ** 2 for a, b in zip(p, c, strict=True)) for c in centroids]
            found.append((far.index(min(far)), min(far)))
        return found

    for _ in range(3):
        members = [[p for p, (c, _) in zip(points, assign(), strict=True) if c == k] for k in range(len(centroids))]
        centroids = [[sum(x) // len(own) for x in zip(*own, strict=True)] if own else centroids[k] for k, own in enumerate(members)]
    last = assign() if points else []
    sums = [sum(d for c, d in last if c == k) for k in range(len(centroids))]
    short = lambda x: x if x < 2**63 else None
    whole = short(sum(sums))
    of = [None if any(c == k and short(d) is None for c, d in last) else short(sums[k]) for k in range(len(centroids))]
    whole = None if None in of else whole
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(map(repr, [(i, c, short(d), of[c], whole, names[c]) for (i, _), (c, d) in zip(kept, last, strict=True)]))


def found(frame):
    return sorted(repr(tuple(r)) for r in cl.cluster(frame).collect())


def vectors(rng, count, scale=1.0):
    """Single-precision vectors around a few centres."""
    centres = [[rng.gauss(0, scale) for _ in range(64)] for _ in range(7)]
    return [(i, [float(np.float32(x + rng.gauss(0, scale / 4))) for x in rng.choice(centres)]) for i in range(count)]


def test_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert found(frame) == plain(rows)


def test_ties_copies_and_awkward_vectors(spark):
    rng = random.Random(1)
    rows = vectors(rng, 60)
    rows += [(100 + i, [float(x) for x in rng.choices([0, 1], k=64)]) for i in range(20)]
    rows += rows[:5]  # repeated rows
    rows += [(200 + i, [0.0] * 64) for i in range(30)]  # a hot vector under many ids
    rows += [(None, [0.5] * 64), (None, [0.25] * 64)]
    good = len(rows)
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [None] * 64)]
    rows += [(305, [1.0] * 63 + [None]), (306, [1.0] * 63 + [math.nan]), (307, [1.0] * 63 + [math.inf]), (308, [-math.inf] * 64)]
    got = found(table(spark, rows))
    assert len(got) == good
    assert got == plain(rows)


def test_few_vectors_and_none(spark):
    rows = vectors(random.Random(2), 5)
    assert found(table(spark, rows)) == plain(rows)
    assert found(table(spark, [])) == []
    assert found(table(spark, [(1, None), (2, [1.0])])) == []


def test_integers_of_any_size_are_exact(spark):
    rng = random.Random(3)
    rows = vectors(rng, 30) + [(100 + i, [float(np.float32(x * 10.0 ** rng.choice([7, 20, 37]))) for x in v]) for i, v in vectors(rng, 30)]
    assert found(table(spark, rows)) == plain(rows)
    rows = vectors(rng, 40, scale=3e6)
    assert found(table(spark, rows)) == plain(rows)


def test_doubles_are_not_rounded(spark):
    rows = [(i, [x + 1e-12 for x in v]) for i, v in vectors(random.Random(4), 40)]
    assert found(table(spark, rows, "double")) == plain(rows)


def test_the_bound_holds_and_spares_work():
    rng = np.random.RandomState(5)
    # Most of the variance lies in few directions.
    spread = np.linalg.qr(rng.normal(size=(64, 64)))[0] * (2.0 ** -np.arange(64) * 5000 + 5)
    rows = np.floor(rng.normal(size=(800, 64)) @ spread.T)
    turn = np.linalg.eigh(np.cov(rows.T))[1][:, ::-1]
    centroids = [[int(x) for x in r] for r in rows[:16]]
    lead, rest = cl.rotate(rows, turn)
    taken, least, worked = cl.nearest(rows, lead, rest, centroids, turn)
    far = ((rows[:, None].astype(int) - np.array(centroids)[None]) ** 2).sum(axis=2)
    assert (taken == far.argmin(axis=1)).all()
    assert (least == far.min(axis=1)).all()
    assert worked < 0.4 * far.size


def test_limbs_add_up():
    rng = random.Random(6)
    numbers = [rng.choice([-1, 1]) * rng.randrange(2**170) for _ in range(50)] + [0, -1, 2**160]
    sums = [sum(x) for x in zip(*map(cl.limbs, numbers), strict=True)]
    assert sum(s << (cl.LIMB_BITS * i) for i, s in enumerate(sums)) == sum(numbers)
    assert all(abs(s) < 2**63 for s in sums)
