import hashlib
import math

import numpy as np
import pytest

from gaugeline.llm import mean_search

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance int, x int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA)


def slow(rows, centroids=16, rounds=3, size=64):
    """Every centroid for every vector, in Python's whole numbers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    at = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:centroids]]
    for k in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at)) for _, v in kept]
        if k < rounds:
            for n in range(len(at)):
                own = [v for (_, v), (_, m) in zip(kept, near) if m == n]
                if own:
                    at[n] = [sum(x) // len(own) for x in zip(*own)]
    inertia = [sum(d for d, m in near if m == n) for n in range(len(at))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((i, n, d, inertia[n], sum(inertia), sha[n]) for (i, _), (d, n) in zip(kept, near)), key=repr)


def run(spark, rows, **settings):
    found = mean_search.digest(mean_search.cluster(table(spark, rows), **settings))
    return sorted(map(tuple, found.collect()), key=repr)


def some(seed, n, size=64):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(9, size))
    return [(i, (middles[i % 9] + rng.normal(size=size) / 3).tolist()) for i in range(n)]


def test_against_all_centroids(spark):
    rows = some(0, 200)
    assert run(spark, rows) == slow(rows)


def test_ties_and_edges(spark):
    nan, inf = float("nan"), float("inf")
    flat = [0.0] * 64
    rows = [(i, [float((i + j) % 2) for j in range(64)]) for i in range(40)]  # two vectors, equal means
    rows += [(100 + i, flat) for i in range(30)] + [(None, flat), (None, [1.0] * 64), (5, flat), (5, flat)]
    rows += [(200, None), (201, []), (202, flat[:-1]), (203, flat + [0.0]), (204, [nan] + flat[1:])]
    rows += [(205, [inf] + flat[1:]), (206, [None] + flat[1:]), (207, [-0.001] * 64), (208, [200000.0, -200000.0] * 32)]
    assert run(spark, rows) == slow(rows)
    assert run(spark, rows[:7]) == slow(rows[:7])
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == []


def test_other_shapes(spark):
    rows = some(4, 90, size=5)
    assert run(spark, rows, centroids=4, rounds=2, components=5) == slow(rows, 4, 2, 5)


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="not below"):
        run(spark, [(1, [1e6] * 64)])
    with pytest.raises(ValueError):
        mean_search.cluster(table(spark, []), components=100)


def test_search_skips_centroids_and_is_exact():
    rng = np.random.default_rng(1)
    shift = rng.integers(-300, 300, size=(40, 1))
    centroids = rng.integers(-40, 40, size=(40, 64)) + shift
    vectors = centroids[rng.integers(0, 40, size=3000)] + rng.integers(-9, 10, size=(3000, 64))
    number, distance, examined = mean_search.MeanSearch(centroids).nearest(vectors)
    every = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert examined.mean() < 10


def test_large_numbers_are_exact():
    top = mean_search.LARGEST - 1
    centroids = np.array([[top] * 64, [-top] * 64, [top, -top] * 32], dtype=np.int64)
    number, distance, _ = mean_search.MeanSearch(centroids).nearest(np.vstack([centroids, centroids + [[-1], [1], [0]]]))
    assert number.tolist() == [0, 1, 2, 0, 1, 2] and distance.tolist() == [0, 0, 0, 64, 64, 0]

