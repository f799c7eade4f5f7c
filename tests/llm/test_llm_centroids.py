"""Centroid clustering against plain distances to all centroids."""

import hashlib
import math
import random

import numpy as np
import pytest

from retailoom.llm.centroids import LARGEST, SortedLists, cluster_vectors, with_inertia

SCHEMA = "vec_id long, embedding array<double>, cluster int, distance string"


def brute_force(rows, k, rounds, width, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(centroids)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = sum(d for _, _, d in found)
    own = {n: sum(d for _, m, d in found if m == n) for n in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, own[n], total, digest[n]) for i, n, d in found), key=repr)


def clustered(spark, rows, k, rounds, width):
    frame = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], SCHEMA)
    found = with_inertia(*cluster_vectors(frame, k=k, rounds=rounds, width=width))
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("seed", range(8))
def test_the_walk_finds_the_nearest_centroid(seed):
    rng = np.random.default_rng(seed)
    k, width, wide = int(rng.integers(1, 40)), int(rng.integers(1, 12)), int(rng.choice([2, 9, 1000]))
    centroids = rng.integers(-wide, wide, (k, width))
    vectors = rng.integers(-wide, wide, (300, width))
    vectors[:50] = centroids[rng.integers(0, k, 50)]  # vectors on a centroid
    number, best, measured = SortedLists(centroids).nearest(vectors)
    every = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (best == every.min(axis=1)).all()
    assert (number == every.argmin(axis=1)).all()  # of equal ones the smaller number
    assert (measured <= k).all()


def test_the_walk_stops_early():
    centroids = np.arange(0, 1000, 10)[:, None] * np.ones((1, 3), np.int64)
    _, _, measured = SortedLists(centroids.astype(np.int64)).nearest(np.array([[501, 500, 502], [0, 0, 0]]))
    assert measured.max() <= 3


def test_the_walk_with_the_largest_components():
    rng = np.random.default_rng(0)
    centroids = rng.choice([-LARGEST, LARGEST], (5, 64))
    number, best, _ = SortedLists(centroids).nearest(-centroids)
    every = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids] for v in -centroids]
    assert best.tolist() == [min(row) for row in every]
    assert number.tolist() == [row.index(min(row)) for row in every]


def test_against_all_distances(spark):
    rng = random.Random(5)
    rows = [(n, [rng.uniform(-1, 1) for _ in range(6)]) for n in range(300)]
    rows += [(300 + n, rows[n % 5][1]) for n in range(200)]  # copies of a few vectors
    rows += [(600, None), (601, []), (602, [0.5] * 5), (603, [None] * 6), (604, [math.nan] * 6), (605, [math.inf] * 6), (606, [1e300] * 6)]
    rows += [(None, [0.25] * 6), (None, [0.25] * 6), rows[3], (rows[4][0], [0.9] * 6)]
    taken = [r for r in rows if r[0] != 606]  # immense components are left out
    assert clustered(spark, rows, 7, 3, 6) == brute_force(taken, 7, 3, 6)


def test_empty_clusters_stay(spark):
    rows = [(n, [0.5, 0.5]) for n in range(9)]  # all centroids are the same, so all but the first are empty
    assert clustered(spark, rows, 4, 2, 2) == brute_force(rows, 4, 2, 2)


def test_few_and_no_vectors(spark):
    assert clustered(spark, [], 4, 2, 2) == []
    assert clustered(spark, [(1, None), (2, [1.0])], 4, 2, 2) == []
    rows = [(1, [0.1, -0.1]), (2, [5.0, 5.0])]
    assert clustered(spark, rows, 16, 3, 2) == brute_force(rows, 16, 3, 2)
