import pytest
from helpers import message, messages, reading

from gaugeline.operators.readings import parse_readings
from gaugeline.plans import catalogue
from gaugeline.streaming import fan_out


def test_one_large_file_is_landed_in_even_files(spark, at):
    """A stream reads a row group in one task, and the tables may be one file with one of them."""
    catalogue._land(spark.range(4000).coalesce(1), at("landing"))
    landed = spark.read.parquet(at("landing"))
    sizes = [r["count"] for r in landed.groupBy("_metadata.file_path").count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) <= 2 * min(sizes)
    assert sorted(r["id"] for r in landed.collect()) == list(range(4000))


@pytest.mark.parametrize("sinks, held", [(["archive"], 0), (["latest"], 0), (["archive", "latest"], 1)])
def test_a_batch_is_held_only_for_several_sinks(spark, at, monkeypatch, sinks, held):
    calls = []
    rows = parse_readings(messages(spark, [message(reading(1, 1), 0), message("bad", 1)]))
    monkeypatch.setattr(rows, "persist", lambda: calls.append(1) or rows)
    fan_out.process_batch(rows, 0, at("out"), "r", sinks)
    assert len(calls) == held
