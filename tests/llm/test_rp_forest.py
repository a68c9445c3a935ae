import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import rp_forest

SCHEMA = "vec_id long, embedding array<float>, vector string, leaf int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1) for i, v in rows], SCHEMA)


def slow(rows, is_query, k):
    usable = {
        (i, tuple(np.float32(x) for x in v))
        for i, v in rows
        if i is not None and v and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    found = {}
    for q, v in usable:
        if is_query(q):
            a = np.array(v, dtype=float)
            near = [(-float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)), i) for i, b in ((i, np.array(w, dtype=float)) for i, w in usable) if i != q]
            found[q] = sorted((round(s, 9), i) for s, i in near)[:k]
    return found


def run(spark, rows, k=5, **settings):
    found = rp_forest.nearest(table(spark, rows), F.col("vec_id") % 10 == 0, k, **settings).collect()
    lists = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        lists.setdefault(r["query_id"], []).append((round(-r["score"], 9), r["vec_id"]))
        assert r["rank"] == len(lists[r["query_id"]])
    return lists


def test_everything_opened_is_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(300 + i, [1.0] * 8) for i in range(90)]  # one very common vector, with queries among it
    rows += [(400, None), (401, [0.0] * 8), (402, [1.0] * 7 + [None]), (410, [float("nan")] * 8), (420, [float("inf")] * 8), (430, []), (440, [1.0, 2.0]), (None, [1.0] * 8)]
    rows += [rows[0], rows[10], (0, rows[0][1])]
    found = run(spark, rows, trees=3, depth=3, share=99.0, block=16)
    assert found == slow(rows, lambda q: q % 10 == 0, 5)


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 8))
    rows = [(i, (centres[i % 20] + 0.4 * rng.normal(size=8)).tolist()) for i in range(1500)]
    found, expected = run(spark, rows, depth=5, share=1.0), slow(rows, lambda q: q % 10 == 0, 5)
    assert found.keys() == expected.keys()
    hits = sum(len({i for _, i in found[q]} & {i for _, i in expected[q]}) for q in expected)
    assert hits / (5 * len(expected)) >= 0.9


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    rows = [(10 * i, [1.0 + i] * 4 + [0.5] * 4) for i in range(n)]
    found = run(spark, rows)
    assert {q: len(x) for q, x in found.items()} == ({} if n < 2 else {q: n - 1 for q, _ in rows})


def test_queue_opens_nearest_planes_first():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(256, 6))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    forest = rp_forest.grow(points, trees=4, depth=4)
    leaves = forest.leaves(points)
    sizes = np.zeros((4, 16), dtype=int)
    for t in range(4):
        sizes[t] = np.bincount(leaves[:, t], minlength=16)
    opened = forest.open_leaves(points[7], sizes, 4 * 256)
    assert sorted(opened) == [(t, n) for t in range(4) for n in range(16) if sizes[t, n]]
    assert {opened[t][0] for t in range(4)} == {0, 1, 2, 3}
    assert all((t, leaves[7, t]) in opened[:4] for t in range(4))
    assert sum(sizes[t, n] for t, n in forest.open_leaves(points[7], sizes, 30)) >= 30


def test_ties_go_to_the_smallest_ids(spark):
    v = [0.3, -0.7, 0.1, 0.9, 0.2, 0.4, -0.5, 0.6]
    rows = [(0, v)] + [(i, [x * 2.0 ** (i % 41 - 20) for x in v]) for i in range(1, 60)]
    found = run(spark, rows, k=5)
    assert [i for _, i in found[0]] == [1, 2, 3, 4, 5] and found[0][0][0] == -1.0


def test_many_parallel_vectors_that_are_no_powers_of_two(spark):
    v = np.array([3, -7, 1, 9, 2, 4, -5, 6], dtype=float)
    rows = [(i, (v * (i % 50 + 1)).tolist()) for i in range(200)]
    found = run(spark, rows, k=5)
    expected = slow(rows, lambda q: q % 10 == 0, 5)
    assert {q: [s for s, _ in got] for q, got in found.items()} == {q: [s for s, _ in got] for q, got in expected.items()}


def test_tiny_and_huge_components(spark):
    table_ = spark.createDataFrame(
        [(0, [1e-200, 0.0]), (1, [1e200, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1e-300]), (4, [5e-324, 0.0]), (5, [1.0, 1.0])],
        "vec_id long, embedding array<double>",
    )
    found = rp_forest.nearest(table_, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [1, 2, 4, 5, 3]
    assert [r["score"] for r in found] == pytest.approx([1, 1, 1, 0.5**0.5, 0])
