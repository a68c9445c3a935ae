import random

import pytest
from helpers import as_dict, plan, puts, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gaugeline.operators import latest
from gaugeline.schemas import PUT_LOG


def test_put_and_get(spark):
    log = puts(spark, [(1, "hello", "world"), (1, "foo", "bar")])
    assert latest.get(log, "hello").first()["value"] == "world"
    assert latest.get(log, "foo").first()["value"] == "bar"


def test_overwrite_keeps_last(spark):
    log = puts(spark, [(1, "k", "v1"), (1, "k", "v2"), (1, "k", "v3")])
    assert as_dict(latest.snapshot(log)) == {"k": "v3"}


def test_missing_key(spark):
    log = puts(spark, [(1, "k", "v")])
    assert latest.get(log, "ghost").count() == 0
    asked = spark.createDataFrame([("k",), ("ghost",)], "key string")
    assert as_dict(latest.get_many(log, asked)) == {"k": "v", "ghost": None}


def test_list_of_keys(spark, at):
    puts(spark, [(1, f"k{i % 50}", str(i)) for i in range(500)]).write.parquet(at("log"))
    log = spark.read.schema(PUT_LOG).parquet(at("log"))
    asked = spark.createDataFrame([(f"k{i}",) for i in [3, 49, 49, 60]] + [(None,)], "key string")
    found = latest.get_many(log, asked)
    assert "LeftSemi" in plan(found)
    assert rows(found) == sorted(
        [("k3", "453"), ("k49", "499"), ("k49", "499"), ("k60", None), (None, None)], key=repr
    )


def test_large_data_over_several_files(spark):
    log = puts(spark, [(i // 500, f"key-{i}", "x" * 300 + f"-{i}") for i in range(5000)])
    found = as_dict(latest.snapshot(log))
    assert len(found) == 5000
    assert found["key-4999"] == "x" * 300 + "-4999"


def test_restart_with_overwrites(spark):
    written = [(1, f"r-{i}", f"val-{i}") for i in range(1000)]
    written += [(2, f"r-{i}", f"updated-{i}") for i in range(100)]
    found = as_dict(latest.snapshot(puts(spark, written)))
    assert found["r-99"] == "updated-99" and found["r-100"] == "val-100"


def test_position_beats_clock(spark):
    log = spark.createDataFrame(
        [("k", "old", 900, 1, 7), ("k", "new", 100, 2, 0), ("j", "a", 5, 1, 1), ("j", "b", 5, 1, 2)],
        PUT_LOG,
    )
    assert as_dict(latest.snapshot(log)) == {"k": "new", "j": "b"}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 5), st.text(max_size=5)), min_size=1, max_size=30))
def test_replay_is_the_last_put(spark, drawn):
    written = [(f, f"k{k}", v) for f, k, v in sorted(drawn, key=lambda d: d[0])]
    log = puts(spark, written)
    assert as_dict(latest.snapshot(log)) == {k: v for _, k, v in written}
    assert rows(latest.replay(latest.replay(log))) == rows(latest.replay(log))


@pytest.mark.parametrize("writers", [8])
def test_many_writers_lose_nothing(spark, writers):
    written = [(1, f"t{t}-k{i}", f"val-{t}-{i}") for t in range(writers) for i in range(500)]
    random.Random(0).shuffle(written)
    log = puts(spark, written).repartition(writers)
    assert as_dict(latest.snapshot(log)) == {k: v for _, k, v in written}


def test_hot_key(spark):
    written = [(1, "hot" if i % 3 == 0 else f"k{i}", str(i)) for i in range(3000)]
    found = as_dict(latest.snapshot(puts(spark, written)))
    assert found["hot"] == "2997" and len(found) == 2001
