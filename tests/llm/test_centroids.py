"""Centroid clustering against full scans."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster int, distance long, ids long, label int"


def plain(rows, clusters, rounds, size, seed="2"):
    able = [(i, v) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    if not able:
        return Counter()
    whole = [[math.floor(256 * x) for x in v] for _, v in able]
    name = lambda k: hashlib.sha256(f"{seed}:{'' if able[k][0] is None else able[k][0]}".encode()).hexdigest()
    order = sorted(range(len(able)), key=lambda k: (name(k), whole[k]))
    centres = [whole[k] for k in order[:clusters]]
    for turn in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres)) for v in whole]
        if turn < rounds:
            for k in range(len(centres)):
                own = [v for v, (_, c) in zip(whole, near) if c == k]
                if own:
                    centres[k] = [sum(column) // len(own) for column in zip(*own)]
    inertia = Counter()
    for d, c in near:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, c, d, inertia[c], inertia.total(), digest[c]) for (i, _), (d, c) in zip(able, near))


def check(spark, rows, clusters, rounds, size):
    frame = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA)
    found = Counter(map(tuple, centroids.clustered(frame, clusters, rounds, size).collect()))
    assert found == plain(rows, clusters, rounds, size)


def test_against_full_scans(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal(size=8)
    rows = [(i, list(map(float, rng.normal(size=8) + (i % 5)))) for i in range(900)]
    rows += [(1000 + i, list(map(float, hot + rng.normal(size=8) * 0.01))) for i in range(400)]
    rows += [(2000 + i, list(map(float, hot))) for i in range(200)]
    rows += [(5, None), (6, []), (7, [1.0] * 7), (8, [None] + [1.0] * 7), (9, [float("nan")] * 8), (10, [float("inf")] * 8)]
    rows += [(None, [0.5] * 8), (None, [0.25] * 8), (3, [0.0] * 8), (3, [0.0] * 8)]
    check(spark, rows, 12, 5, 8)


def test_ties_and_few_vectors(spark):
    grid = [[float(a), float(b)] for a in range(4) for b in range(4)] * 5
    check(spark, list(enumerate(grid)), 6, 4, 2)
    check(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])], 5, 3, 2)
    check(spark, [], 5, 3, 2)
    check(spark, [(1, None)], 5, 3, 2)


@pytest.mark.parametrize("scale", [2.0**12, 2.0**16])
def test_large_components(spark, scale):
    rng = np.random.default_rng(1)
    check(spark, [(i, (rng.normal(size=3) * scale).tolist()) for i in range(60)], 4, 3, 3)


def test_components_beyond_all_integers(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=3) * 1e30).tolist()) for i in range(30)]
    frame = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA)
    found = {r["vec_id"]: r["cluster"] for r in centroids.clustered(frame, 4, 3, 3).collect()}
    assert found == {k[0]: k[1] for k in plain(rows, 4, 3, 3)}


def test_only_expired_vectors_are_scanned():
    rng = np.random.default_rng(4)
    centres = [[0] * 4, [100_000] * 4]
    vectors = np.concatenate([rng.integers(0, 50, (500, 4)), 100_000 + rng.integers(0, 50, (500, 4))])
    made = centroids.Centres(centres)
    best, keys = made.scan(vectors, np.zeros(2))
    heaps = centroids._sorted_heaps(best, keys, 2)
    moved = [[3] * 4, [100_003] * 4]
    drift = centroids._drifted(np.zeros(2), centres, moved)
    at, _, after = centroids._renewed(vectors, best, heaps, centroids.Centres(moved), drift)
    assert len(at) == 0 and after is heaps
    moved = [[3] * 4, [-100] * 4]
    drift = centroids._drifted(drift, centres, moved)
    at, again, (sizes, keys, rows) = centroids._renewed(vectors, best, heaps, centroids.Centres(moved), drift)
    assert len(at) == 1000 and sizes.sum() == 1000 and sorted(rows) == list(range(1000))
    squares = ((vectors[at][:, None] - np.array(moved)) ** 2).sum(axis=2)
    assert (again == squares.argmin(axis=1)).all()
    begin = 0
    for size in sizes:  # every heap is one
        part = keys[begin : begin + size]
        assert all(part[(i - 1) // 2] <= part[i] for i in range(1, size))
        begin += size
