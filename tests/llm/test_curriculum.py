import hashlib
import random

import pytest

from gaugeline.llm import curriculum


def slow_targets(sizes, weights=curriculum.WEIGHTS, share=1.5, passes=2):
    """Share by weight; what a full source cannot take goes round again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ones = {s: 0.0 for s in names}, share * sum(sizes.values()), set(names)
    while left > 1e-9 and open_ones:
        each = left / sum(weight[s] for s in open_ones)
        left = 0.0
        for s in list(open_ones):
            target[s] += each * weight[s]
            if target[s] >= passes * sizes[s]:
                left += target[s] - passes * sizes[s]
                target[s] = passes * sizes[s]
                open_ones.discard(s)
    return target


def rows_of(rng, n=300):
    rows = []
    for i in range(n):
        source = rng.choice(["b", "a", "é", None, "hot", "hot", "hot"])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 3, 10, 40, 200])), source))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_targets_are_met_in_whole_documents(spark, documents, seed):
    rng = random.Random(seed)
    rows = rows_of(rng) + [(None, "x y", "a"), (7, None, "b"), (8, "x y z", "hot"), (8, "x y z", "hot"), (500, "few words", "small")]
    found = curriculum.mix(documents(rows)).collect()
    assert len(found) == len(rows)
    sizes, largest = {}, {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
        largest[s] = max(largest.get(s, 0), len((t or "").split()))
    expected = slow_targets(sizes)
    taken = {s: 0 for s in sizes}
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]], rel=1e-9)
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        assert len(r["positions"]) == r["copies"] and all(0 <= p <= 1 for p in r["positions"])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= max(1, largest[s] / 2)


def test_demand_follows_the_schedule(spark, documents):
    """Up to any moment, a source has given about the integral of its schedule."""
    rows = [(i, "w " * 5, s) for i, s in enumerate(["a", "b", "c"] * 400)]
    found = curriculum.mix(documents(rows)).collect()
    for turn, s in enumerate("abc"):
        (_, w0), (_, w1) = curriculum.SCHEDULES[turn]
        places = sorted(p for r in found if r["source"] == s for p in r["positions"])
        for moment in (0.1, 0.35, 0.5, 0.8):
            due = (w0 * moment + (w1 - w0) * moment**2 / 2) / ((w0 + w1) / 2)
            assert sum(p <= moment for p in places) / len(places) == pytest.approx(due, abs=0.01)


def test_schedule_of_several_spans(spark, documents):
    schedule = ((0.0, 0.0), (0.5, 2.0), (0.75, 0.0), (1.0, 1.0))
    found = curriculum.mix(documents([(i, "w w", "a") for i in range(800)]), schedules=[schedule]).collect()
    places = sorted(p for r in found for p in r["positions"])
    area = [0.5, 0.25, 0.125]
    for moment, done in ((0.5, area[0]), (0.75, area[0] + area[1]), (1.0, sum(area))):
        assert sum(p <= moment + 1e-9 for p in places) / len(places) == pytest.approx(done / sum(area), abs=0.01)


def test_rerun_and_order_of_rows_change_nothing(spark, documents):
    rows = rows_of(random.Random(9))
    first = curriculum.mix(documents(rows)).collect()
    again = curriculum.mix(documents(rows[::-1]).repartition(7)).collect()
    assert first == again
    firsts = [r["positions"][0] for r in first if r["positions"]]
    assert firsts == sorted(firsts) and not first[-1]["positions"]


def test_order_within_a_source_is_that_of_md5(spark, documents):
    found = curriculum.mix(documents([(i, "w", "a") for i in range(50)])).collect()
    order = sorted(range(50), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    assert [r["doc_id"] for r in sorted(found, key=lambda r: r["positions"][0])] == order


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, " ", None)]])
def test_nothing_to_take(spark, documents, rows):
    found = curriculum.mix(documents(rows)).collect()
    assert [(r["taken"], r["target"]) for r in found] == [(0, 0.0)] * len(rows)
