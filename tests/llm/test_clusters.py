"""Clustering against Lloyd's rounds that measure every distance."""

from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pytest

from quarterfold.llm import op12_pivots
from tests.llm.helpers import rows_of

SCHEMA = "vec_id long, embedding array<float>, v int, near string, cluster string, n int"


def expected(rows, k, rounds, dimensions):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, [math.floor(1024 * float(np.float32(x))) for x in e]))
    kept.sort(key=lambda r: (r[0] is None, sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in kept[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            of = [v for (_, v), a in zip(kept, at, strict=True) if a == j]
            if of:
                centroids[j] = [sum(x) // len(of) for x in zip(*of, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = {j: sum(d for _, a, d in found if a == j) for j in range(len(centroids))}
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, total[j], sum(total.values()), digest[j]) for i, j, d in found), key=str)


def odd_vectors(dimensions):
    r = np.random.default_rng(5)
    rows = [(k, (r.normal(k % 5, 0.3, dimensions)).tolist()) for k in range(120)]
    rows += [(200 + k, [0.5] * dimensions) for k in range(60)]  # a third is one vector
    rows += [(300, None), (301, []), (302, [1.0] * (dimensions - 1)), (303, [None] + [1.0] * (dimensions - 1)),
             (304, [math.nan] + [1.0] * (dimensions - 1)), (305, [math.inf] + [1.0] * (dimensions - 1)),
             (306, [-90000.0] * dimensions), (None, [2.0] * dimensions), (7, [3.0] * dimensions), (7, [3.0] * dimensions)]
    return rows


@pytest.mark.parametrize(("k", "rounds", "dimensions"), [(8, 3, 64), (3, 10, 4)])
def test_odd_vectors(spark, k, rounds, dimensions):
    rows = odd_vectors(dimensions)
    vectors = spark.createDataFrame([(i, e, 1, "x", "y", 2) for i, e in rows], SCHEMA)
    got = op12_pivots.clustered(vectors, k, rounds, dimensions=dimensions)
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert rows_of(got, *names) == expected(rows, k, rounds, dimensions)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.25] * 64)], [(k, [0.25] * 64) for k in range(20)]])
def test_fewer_vectors_than_centroids_or_equal_ones(spark, rows):
    vectors = spark.createDataFrame([(i, e, 1, "x", "y", 2) for i, e in rows], SCHEMA)
    got = op12_pivots.clustered(vectors)
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert rows_of(got, *names) == expected(rows, 8, 10, 64)


@pytest.mark.parametrize("size", [1 << 6, 1 << 12, 1 << 20, op12_pivots.LARGEST])
def test_bounds_hold_and_spare_work(size):
    """Also where many vectors lie at equal distances, and where doubles can't hold squared distances."""
    r = np.random.default_rng(size)
    pivots = r.integers(-size, size, (8, 64))
    vectors = np.concatenate([pivots[r.integers(0, 8, 3000)] + r.integers(-size // 16, size // 16 + 1, (3000, 64)),
                              r.integers(-1, 2, (1000, 64)), pivots, r.integers(-size, size, (500, 64))])
    vectors = np.clip(vectors, -size, size)
    for centroids in (pivots, vectors[r.integers(0, len(vectors), 8)], np.repeat(pivots[:1], 8, axis=0)):
        bounds = op12_pivots.Bounds(centroids, pivots)
        exact = np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)
        cached = op12_pivots.distances(vectors, pivots)
        assert (bounds.least(cached) <= np.sqrt(exact.astype(np.longdouble))).all()
        cluster, best, measured = bounds.assigned(vectors, cached)
        assert (cluster == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
        if centroids is pivots:
            assert measured < 0.5 * exact.size
