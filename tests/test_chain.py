import os
import time

import pytest
from helpers import as_dict, message, messages, reading, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gaugeline.operators.readings import parse_readings, valid_readings
from gaugeline.schemas import READING_DOCUMENT
from gaugeline.sinks import bucketed
from gaugeline.sinks.progress import counted
from gaugeline.sinks.progress_log import ProgressLog, progress
from gaugeline.sources.messages import landed_stream
from gaugeline.streaming import chain, fan_out, jobs


@pytest.fixture
def send(spark, at):
    """Land one poll of (offset, body) messages, and the stream of them."""
    polls = []

    def land(*sent):
        messages(spark, [message(body, offset) for offset, body in sent]).coalesce(1).write.mode("append").parquet(at("topic"))
        polls.append(1)
        for name in os.listdir(at("topic")):
            file = os.path.join(at("topic"), name)
            if name.endswith(".parquet") and os.stat(file).st_mtime > 1e9 + 1000:
                os.utime(file, (1e9 + len(polls), 1e9 + len(polls)))
        return landed_stream(spark, at("topic"), max_files=1)

    return land


def test_a_failing_sink_holds_up_no_other(spark, at, send):
    topic = send((0, reading(1, 1)), (1, reading(1, 1, humidity=9)), (2, "bad"), (3, reading(2, 1)))
    chain.start_intake(topic, at("out"), at("ck")).awaitTermination()
    down = [(F.raise_error(F.lit("store is down")).isNull(), "never")]
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            chain.start_sink(spark, at("out"), fan_out.DOCUMENTS, at("ck-documents"), down).awaitTermination()
        for sink in (fan_out.ARCHIVE, fan_out.LATEST, fan_out.DEAD_LETTERS):
            chain.start_sink(spark, at("out"), sink, at(f"ck-{sink}")).awaitTermination()
    assert fan_out.archived(spark, at("out")).count() == 2
    assert set(as_dict(fan_out.latest_values(spark, at("out")))) == {"1", "2"}
    assert fan_out.dead_letters(spark, at("out")).count() == 1
    assert fan_out.indexed_documents(spark, at("out")).count() == 0
    chain.start_sink(spark, at("out"), fan_out.DOCUMENTS, at("ck-documents")).awaitTermination()
    assert {r["doc_id"] for r in fan_out.indexed_documents(spark, at("out")).collect()} == {"1-1", "2-1"}


def test_latest_state_writes_changed_keys_only(spark, at, send):
    topic = send(*[(i, reading(i, 1)) for i in range(30)])

    def drain():
        chain.start_intake(topic, at("out"), at("ck")).awaitTermination()
        chain.start_latest_state(spark, at("out"), at("ck2")).awaitTermination()
        return chain.latest_state_table(spark, at("out"))

    before = drain().versions.state().live
    send((30, reading(3, 2, humidity=7)))
    stored = drain()
    after = stored.versions.state().live
    assert sum(before[b] != after[b] for b in before) == 1
    found = as_dict(stored.rows())
    assert len(found) == 30 and '"humidity":7' in found["3"] and '"humidity":50' in found["4"]


def test_a_landed_batch_is_there_once(spark, at):
    rows_ = spark.createDataFrame([(1,)], "n long")
    assert chain.land_batch(rows_, at("t"), "r", 0)
    assert not chain.land_batch(rows_, at("t"), "r", 0)
    assert chain.land_batch(rows_, at("t"), "s", 0)
    assert len([n for n in os.listdir(at("t")) if not n.startswith(".")]) == 2


def test_progress_is_logged_once_per_batch(spark, at, send):
    log = ProgressLog(spark, at("log"))
    try:
        topic = send((0, reading(1, 1)), (1, "bad"))
        send((2, reading(1, 2)), (3, reading(1, 3)))
        valid = valid_readings(parse_readings(topic))
        for _ in range(2):
            running = jobs.start(counted(valid, "indexed").writeStream.format("noop"), at("ck"))
            running.awaitTermination()
            assert log.wait_for(running)
    finally:
        log.close()
    found = progress(spark, at("log")).orderBy("batch_id").collect()
    assert [(r["sink"], r["batch_id"], r["rows"]) for r in found] == [("indexed", 0, 1), ("indexed", 1, 2)]
    assert len({r["query"] for r in found}) == 1


def test_bucketed_tables_are_joined_by_id(spark, at):
    name = f"index_{time.time_ns()}"
    for k, ids in (("old", ["1-1", "1-2"]), ("new", ["1-2", "1-3"])):
        for _ in range(2):
            bucketed.create_bucketed_index(spark, f"{name}_{k}", at(k), buckets=4)
        some = [(i, 1, 1, k, 1, 1, 1, 1) for i in ids]
        bucketed.fill(spark.createDataFrame(some, READING_DOCUMENT), f"{name}_{k}", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = bucketed.upserted(spark, f"{name}_old", f"{name}_new")
        assert rows(found.select("doc_id", "battery_status")) == [("1-1", "old"), ("1-2", "new"), ("1-3", "new")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for k in ("old", "new"):
            spark.sql(f"DROP TABLE {name}_{k}")
