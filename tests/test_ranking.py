import random

import pytest
from helpers import plan
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeline.operators.ranking import dedup_first, dedup_within, first_per_key, last_per_key
from gaugeline.operators.sequence import sequence_numbers

SCHEMA = "station_id long, s_no long, partition int, offset long, arrived long, payload string"


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("timestamp", F.timestamp_seconds("arrived"))


def skewed(n=600, seed=1):
    """A third of the rows share one id."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = (1, 1) if i % 3 == 0 else (rng.randrange(4), rng.randrange(30))
        rows.append((*key, rng.randrange(3), i, i * 10, f"p{i}"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("pick, rank", [(first_per_key, min), (last_per_key, max)])
def test_one_per_key(spark, pick, rank):
    rows = skewed()
    expected = {}
    for r in rows:
        best = expected.get(r[:2])
        if best is None or rank((r[2], r[3]), (best[2], best[3])) == (r[2], r[3]):
            expected[r[:2]] = r
    found = pick(table(spark, rows), ["station_id", "s_no"]).drop("timestamp").collect()
    assert sorted(map(tuple, found)) == sorted(expected.values())


def test_hot_key_shrinks_before_the_shuffle(spark, at):
    table(spark, skewed()).write.parquet(at("t"))
    shown = plan(dedup_first(spark.read.parquet(at("t"))))
    before_shuffle = shown[shown.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_dedup_is_idempotent_and_takes_more_keys(spark):
    once = dedup_first(table(spark, skewed()))
    assert sorted(dedup_first(once).collect()) == sorted(once.collect())
    restart = [(1, 1, 0, 0, 100, "before"), (1, 1, 0, 1, 100, "copy"), (1, 1, 0, 2, 900, "after")]
    kept = dedup_first(table(spark, restart), ["station_id", "s_no", "arrived"]).collect()
    assert {r["payload"] for r in kept} == {"before", "after"}


def within(rows, horizon):
    """dedup_within, said plainly."""
    kept, last = [], {}
    for r in sorted(rows, key=lambda r: (r[4], r[2], r[3])):
        if r[:2] not in last or r[4] - last[r[:2]] >= horizon:
            kept.append(r)
            last[r[:2]] = r[4]
    return sorted(kept)


def arrivals(spark, seconds, s_no=1):
    return table(spark, [(1, s_no, 0, i, a, str(a)) for i, a in enumerate(seconds)])


@pytest.mark.parametrize(
    "seconds, kept",
    [
        (range(0, 9901, 900), [0, 1800, 3600, 5400, 7200, 9000]),
        ([900, 1100, 1950], [900, 1950]),
        ([0, 999, 1000, 1001, 1999, 2000], [0, 1000, 2000]),
        (range(0, 20_000, 1), list(range(0, 20_000, 1000))),  # without a pause
    ],
)
def test_a_suppressed_copy_does_not_prolong(spark, seconds, kept):
    found = dedup_within(arrivals(spark, seconds), 1000).collect()
    assert sorted(int(r["payload"]) for r in found) == kept


def test_dedup_within_continues_from_what_was_kept(spark):
    known = spark.createDataFrame([(1, 1, 500), (1, 1, 10**9), (2, 1, 100)], "station_id long, s_no long, arrived long")
    found = dedup_within(arrivals(spark, [0, 500, 1400, 1500, 2400]), 1000, kept=known).collect()
    # 0 came before what was kept, and the kept one with a clock far ahead suppresses nothing.
    assert sorted(int(r["payload"]) for r in found) == [0, 1500]


def test_dedup_within_without_arrival_times(spark):
    rows = [(1, 1, 0, 0, None, "a"), (1, 1, 0, 1, None, "b"), (1, 1, 0, 2, 5, "c"), (None, 1, 0, 3, 5, "d")]
    found = dedup_within(table(spark, rows), 1000).collect()
    assert {r["payload"] for r in found} == {"a", "c", "d"}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 1), st.integers(0, 2), st.integers(0, 400)), max_size=40),
    st.sampled_from([1, 30, 100]),
)
def test_dedup_within_matches_plain_rule(spark, drawn, horizon):
    arrivals = sorted(a for *_, a in drawn)
    rows = [(s, n, 0, i, a, f"p{i}") for i, ((s, n, _), a) in enumerate(zip(drawn, arrivals))]
    found = dedup_within(table(spark, rows), horizon).drop("timestamp").collect()
    found = sorted(map(tuple, found))
    assert found == within(rows, horizon)
    for a in found:
        for b in found:
            if a[:2] == b[:2] and a != b:
                assert abs(a[4] - b[4]) >= horizon


def test_dedup_within_lets_a_restarted_station_pass(spark):
    rows = [(1, 1, 0, 0, 0, "a"), (1, 1, 0, 1, 50, "copy"), (1, 1, 0, 2, 10_000, "b")]
    kept = dedup_within(table(spark, rows), 2400).collect()
    assert {r["payload"] for r in kept} == {"a", "b"}


@pytest.mark.parametrize("blocks", [1, 7, 64])
@pytest.mark.parametrize("stretch", [1, 10**13])
def test_sequence_numbers(spark, blocks, stretch):
    rows = [(*r[:3], r[3] ** 2 * stretch, *r[4:]) for r in skewed(400)]  # sparse offsets
    counters, expected = {}, {}
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        counters[r[0]] = counters.get(r[0], 0) + 1
        expected[r[3]] = counters[r[0]]
    numbered = sequence_numbers(table(spark, rows), name="seq", blocks=blocks)
    assert {r["offset"]: r["seq"] for r in numbered.collect()} == expected


def test_sequence_numbers_lose_no_row(spark):
    rows = [(1, 1, 0, None, 0, "a"), (1, 1, 0, 5, 0, "b"), (1, 1, None, 9, 0, "c"), (None, 1, 0, 7, 0, "d"), (1, 1, 0, None, 0, "e")]
    found = {r["payload"]: r["seq"] for r in sequence_numbers(table(spark, rows), name="seq").collect()}
    assert found["c"] == 1 and {found["a"], found["e"]} == {2, 3} and found["b"] == 4 and found["d"] == 1


def test_sequence_numbers_shuffle_rows_once_by_block(spark, at):
    table(spark, skewed()).write.parquet(at("t"))
    shown = plan(sequence_numbers(spark.read.parquet(at("t")), name="seq"))
    by_key_only = [l for l in shown.splitlines() if "Exchange hashpartitioning(station_id" in l]
    # Every exchange that carries rows is by block; only block counts are gathered by key.
    assert sum("_block" not in l for l in by_key_only) <= 1
