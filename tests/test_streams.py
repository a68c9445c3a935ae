import datetime as dt
import glob
import json
import os
import random
import time

import pandas as pd
import pytest
from helpers import START, as_dict, message, messages, reading, rows

from gaugeline.operators import alerts
from gaugeline.operators.ranking import dedup_first, last_per_key
from gaugeline.operators.latest import puts_from_readings
from gaugeline.operators.readings import parse_readings, valid_readings
from gaugeline.schemas import MESSAGE, READING_COLUMNS
from gaugeline.sinks.archive import dated_readings
from gaugeline.sinks.progress import counted
from gaugeline.sources.messages import kafka_records, landed_stream, landed_table
from gaugeline.sources.tables import observation_stream
from gaugeline.streaming import fan_out, first_arrivals, jobs
from gaugeline.streaming import observations as observed

DAY = 86400


class Topic:
    """Messages landed as one file per poll, in order of file age."""

    def __init__(self, spark, path):
        self.spark, self.path, self.polls = spark, path, 0
        self.offset = 0

    def send(self, *bodies, arrived=None):
        batch = []
        for body in bodies:
            when = self.offset if arrived is None else arrived
            batch.append(message(body, self.offset, arrived=when, key="k"))
            self.offset += 1
        self.land(batch)

    def land(self, batch):
        messages(self.spark, batch).coalesce(1).write.mode("append").parquet(self.path)
        now = time.time()
        for name in os.listdir(self.path):
            file = os.path.join(self.path, name)
            if name.endswith(".parquet") and os.stat(file).st_mtime > 1e9 + 1000:
                # An old, growing age, since polls come faster than file times can tell.
                os.utime(file, (1e9 + self.polls, 1e9 + self.polls))
        assert now
        self.polls += 1

    def stream(self):
        return landed_stream(self.spark, self.path, max_files=1)

    def table(self):
        return landed_table(self.spark, self.path)


@pytest.fixture
def topic(spark, at):
    return Topic(spark, at("topic"))


def fill(topic):
    """Four polls: copies inside a poll and across polls, bad ones, late ones."""
    topic.send(reading(1, 1, humidity=80), reading(1, 1, humidity=81), reading(1, 2), "bad")
    topic.send(reading(1, 1, humidity=82), reading(2, 1, time=1704067200 - 40 * DAY), None)
    topic.send(reading(1, 3, humidity=90), {"weather": {"humidity": 99}}, reading(2, 1))
    topic.send(reading(1, 2, humidity=75), reading(3, 1, humidity="88"))


def first_rows(table):
    return dedup_first(valid_readings(parse_readings(table)))


def test_alert_stream_equals_batch(spark, topic, at):
    fill(topic)
    jobs.alert_stream(topic.stream(), at("alerts"), at("ck")).awaitTermination()
    streamed = landed_table(spark, at("alerts"))
    assert rows(streamed) == rows(alerts.alert_messages(topic.table()))
    assert streamed.count() == 7


def alert_fields(texts):
    return alerts.alert_records(alerts.parse_alerts(texts)).collect()


def test_fan_out_equals_batch(spark, topic, at):
    fill(topic)
    fan_out.start_fan_out(topic.stream(), at("out"), at("ck")).awaitTermination()
    first = first_rows(topic.table())
    assert rows(fan_out.archived(spark, at("out"))) == rows(dated_readings(first))
    assert rows(fan_out.indexed_documents(spark, at("out")).drop("doc_id")) == rows(
        first.select(*READING_COLUMNS)
    )
    newest = last_per_key(puts_from_readings(first), ["key"]).select("key", "value")
    assert rows(fan_out.latest_values(spark, at("out"))) == rows(newest)
    letters = fan_out.dead_letters(spark, at("out")).collect()
    assert sorted(r["offset"] for r in letters) == [3, 6, 8]
    assert {r["value"] for r in letters} == {"bad", None, '{"weather": {"humidity": 99}}'}
    # The first copy won, across polls as well.
    kept = {(r["station_id"], r["s_no"]): r["humidity"] for r in first.collect()}
    assert kept[(1, 1)] == 80 and kept[(3, 1)] == 88


def test_stop_and_resume_loses_and_repeats_nothing(spark, topic, at):
    def drain():
        fan_out.start_fan_out(topic.stream(), at("out"), at("ck")).awaitTermination()

    topic.send(reading(1, 1), reading(1, 2))
    drain()
    topic.send(reading(1, 2, humidity=99), reading(1, 3))
    drain()
    drain()
    found = rows(fan_out.archived(spark, at("out")).select("s_no", "humidity"))
    assert found == [(1, 50), (2, 50), (3, 50)]


def test_replayed_batch_changes_nothing(spark, topic, at):
    """A batch that failed after writing some sinks runs again under its number."""
    topic.send(reading(1, 1), reading(1, 2), "bad")
    topic.send(reading(1, 4, humidity=99), reading(1, 3), "worse")
    everything = parse_readings(topic.table())
    early, late = everything.where("offset < 3"), everything.where("offset >= 3")
    fan_out.process_batch(early, 0, at("out"), "r", ["archive", "documents"])
    for batch_id, batch in [(0, early), (0, early), (1, late), (1, late)]:
        fan_out.process_batch(batch, batch_id, at("out"), "r")

    def state():
        return (
            rows(fan_out.archived(spark, at("out"))),
            rows(fan_out.indexed_documents(spark, at("out"))),
            rows(fan_out.latest_values(spark, at("out"))),
            rows(fan_out.dead_letters(spark, at("out"))),
        )

    before = state()
    assert [len(s) for s in before] == [4, 4, 1, 2]
    fan_out.process_batch(late, 1, at("out"), "r")
    assert state() == before


def test_a_new_checkpoint_on_the_same_root_adds(spark, topic, at):
    """Another run counts its batches from 0 again and replaces nothing but what has newer values."""
    topic.send(reading(1, 1), reading(1, 2), "bad")
    fan_out.start_fan_out(topic.stream(), at("out"), at("ck")).awaitTermination()
    later = Topic(spark, at("later"))
    later.send(reading(2, 1), reading(1, 2, humidity=99), "worse")
    fan_out.start_fan_out(later.stream(), at("out"), at("ck2")).awaitTermination()
    archive = rows(fan_out.archived(spark, at("out")).select("station_id", "s_no", "humidity"))
    assert archive == [(1, 1, 50), (1, 2, 50), (1, 2, 99), (2, 1, 50)]
    documents = {r["doc_id"]: r["humidity"] for r in fan_out.indexed_documents(spark, at("out")).collect()}
    assert documents == {"1-1": 50, "1-2": 99, "2-1": 50}
    assert set(as_dict(fan_out.latest_values(spark, at("out")))) == {"1", "2"}
    assert fan_out.dead_letters(spark, at("out")).count() == 2


def kept_humidity(spark, at, topic, horizon, cuts, sent):
    """Arrivals (s_no, second, partition) cut into micro-batches; what was kept."""
    raw = [
        message(reading(1, s_no, humidity=i % 100), offset=i, partition=part, arrived=second)
        for i, (s_no, second, part) in enumerate(sent)
    ]
    edges = [0, *cuts, len(raw)]
    for a, b in zip(edges, edges[1:]):
        topic.land(raw[a:b])
    fan_out.start_fan_out(topic.stream(), at("out"), at("ck"), ["archive"], horizon).awaitTermination()
    return sorted((r["s_no"], r["humidity"]) for r in fan_out.archived(spark, at("out")).collect())


def test_a_copy_past_the_horizon_passes_beside_one_within(spark, topic, at):
    """Both in one micro-batch: the earlier one is a repeat, and must not shadow the later."""
    sent = [(1, 0, 0), (1, 3599, 0), (1, 3599, 0), (1, 3601, 0)]
    assert kept_humidity(spark, at, topic, 3600, [1], sent) == [(1, 0), (1, 3)]


@pytest.mark.parametrize("cuts", [[], [1, 4, 7, 9]])
def test_copies_closer_than_the_horizon_pass_again(spark, topic, at, cuts):
    sent = [(1, 900 * i, 0) for i in range(12)]
    assert kept_humidity(spark, at, topic, 1000, cuts, sent) == [(1, i) for i in range(0, 12, 2)]


def test_suppressed_copy_does_not_prolong(spark, topic, at):
    assert kept_humidity(spark, at, topic, 1000, [1, 2], [(1, 900, 0), (1, 1100, 0), (1, 1950, 0)]) == [(1, 0), (1, 2)]


@pytest.mark.parametrize("cuts", [[], [2, 4]])
def test_one_clock_ahead_loses_nothing(spark, topic, at, cuts):
    sent = [(1, DAY, 0), (2, 0, 0), (3, 1, 0), (1, 10, 0), (4, 2, 0), (5, 3, 0), (1, 20, 0)]
    expected = [(1, 0), (1, 3), (2, 1), (3, 2), (4, 4), (5, 5)]
    assert kept_humidity(spark, at, topic, 1000, cuts, sent) == expected


def test_partitions_that_drift_apart(spark, topic, at):
    """One partition is hours behind another; all of its distinct ids arrive."""
    sent = [(i, 9000 + i, 0) if i % 2 else (i, i, 1) for i in range(1, 9)]
    assert kept_humidity(spark, at, topic, 600, [2, 5], sent) == [(i + 1, i) for i in range(8)]


def test_arrivals_without_or_of_any_time(spark, topic, at):
    def sent(s_no, arrived):
        return (*message(reading(1, s_no), offset=s_no)[:5], arrived)

    far = [dt.datetime(1, 1, 2, tzinfo=dt.timezone.utc), dt.datetime(9999, 12, 30, tzinfo=dt.timezone.utc), None]
    topic.land([sent(i, t) for i, t in enumerate(far)])
    topic.land([sent(i, t) for i, t in enumerate(far[:2])])
    fan_out.start_fan_out(topic.stream(), at("out"), at("ck"), ["archive"]).awaitTermination()
    assert sorted(r["s_no"] for r in fan_out.archived(spark, at("out")).collect()) == [0, 1, 2]


def test_a_batch_writes_state_of_its_own_ids_only(spark, topic, at):
    """Many ids in mind, few in a batch: its changelog is small, whatever the window holds."""
    topic.land([message(reading(s, n), offset=1000 * s + n, arrived=s) for s in range(40) for n in range(0, 640, 8)])
    topic.land([message(reading(1, 3), offset=90_000, arrived=50)])
    running = fan_out.start_fan_out(topic.stream(), at("out"), at("ck"), ["archive"])
    running.awaitTermination()
    first, second = [p["stateOperators"][0] for p in running.recentProgress if p["numInputRows"]]
    assert first["numRowsUpdated"] == second["numRowsTotal"] == 400
    assert second["numRowsUpdated"] == 1

    def written(version):
        paths = glob.glob(f"{at('ck')}/state/0/*/{version}.changelog")
        return sum(os.path.getsize(p) for p in paths)

    assert 0 < written(2) < written(1) / 10


class Clock:
    """A row of state and its two clocks, as the accepter sees them."""

    def __init__(self):
        self.kept, self.now, self.passed, self.wake, self.hasTimedOut = None, 0, 0, None, False

    get = property(lambda self: self.kept)
    exists = property(lambda self: self.kept is not None)

    def update(self, kept):
        self.kept = kept

    def remove(self):
        self.kept = None

    def setTimeoutTimestamp(self, at):
        assert at > self.passed
        self.wake = at

    def getCurrentProcessingTimeMs(self):
        return self.now

    def getCurrentWatermarkMs(self):
        return self.passed


def test_forgotten_when_both_clocks_say_so():
    def ask(*rows):
        names = ["station_id", "s_no", "_second", "partition", "offset"]
        parts = [pd.DataFrame([(1, *r) for r in rows], columns=names)] if rows else []
        return sorted(n for part in accept((1, 0), iter(parts), state) for n in part["offset"])

    accept, state = first_arrivals._accepter(100, ["offset"]), Clock()
    assert ask((5, 1000, 0, 1), (5, 1050, 0, 2), (6, 1000, 0, 3), (5, 1000, 0, 0)) == [0, 3]
    assert ask((5, 1099, 0, 4)) == [] and ask((5, 1100, 0, 5)) == [5]
    state.hasTimedOut, state.passed = True, 5_000_000
    assert ask() == [] and len(state.kept[0]) == 3  # the arrivals went on, but no time did
    state.now, state.passed = 10_000_000, 1_050_000
    assert ask() == [] and sorted(zip(*state.kept))[0][:2] == (5, 1100)  # one is not past yet
    state.passed = 2_000_000
    assert ask() == [] and not state.exists


def test_unread_messages_are_dealt_over_few_groups(spark, topic, at, monkeypatch):
    """Each group costs a call in Python; without an id there is no reason for one per message."""

    def one_per_group(horizon, names):
        return lambda key, parts, state: (part.head(1)[names] for i, part in enumerate(parts) if i == 0)

    topic.send(*[f"bad {i}" for i in range(500)])
    out = {}
    for name, accepter in (("groups", one_per_group), ("all", first_arrivals._accepter)):
        monkeypatch.setattr(first_arrivals, "_accepter", accepter)
        kept = first_arrivals.first_arrivals(parse_readings(topic.stream()), 100).select("value", "offset")
        jobs.start(kept.writeStream.format("parquet").option("path", at(name)), at(f"ck-{name}")).awaitTermination()
        out[name] = sorted((r["offset"], r["value"]) for r in spark.read.parquet(at(name)).collect())
    assert out["all"] == [(i, f"bad {i}") for i in range(500)]
    assert 1 < len(out["groups"]) <= first_arrivals.UNREAD_GROUPS


def test_only_bad_or_no_messages(spark, topic, at):
    topic.send("bad", None)
    fan_out.start_fan_out(topic.stream(), at("out"), at("ck")).awaitTermination()
    assert fan_out.dead_letters(spark, at("out")).count() == 2
    assert fan_out.latest_values(spark, at("out")).count() == 0


def test_alert_index_keeps_every_column(spark, at):
    raw = messages(spark, [message(reading(1, n, humidity=90), n) for n in range(3)])
    dated = alerts.parse_alerts(alerts.alert_messages(raw)).selectExpr("*", "DATE '2024-05-06' AS date")
    for batch_id in range(3):
        fan_out.process_alert_batch(dated, batch_id, at("out"), "r")
    found = fan_out.indexed_alerts(spark, at("out")).collect()
    assert len(found) == 3 and all(r["event"] and r["status"] for r in found)


def test_console_stream_runs(spark, topic, at, capfd):
    topic.send("bad")
    jobs.console_stream(topic.stream().select("key", "value"), at("ck")).awaitTermination()


def test_rows_are_counted_on_the_stream(spark, topic, at):
    topic.send(reading(1, 1), reading(1, 2), "bad")
    valid = valid_readings(parse_readings(topic.stream()))
    writer = counted(valid, "indexed").writeStream.format("noop")
    running = jobs.start(writer, at("ck"))
    running.awaitTermination()
    seen = [p["observedMetrics"]["indexed"]["rows"] for p in running.recentProgress if p["observedMetrics"]]
    assert sum(seen) == 2


def test_kafka_columns(spark):
    raw = spark.createDataFrame(
        [(b"1", None, "t", 0, 5, None, 0)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int",
    )
    row = kafka_records(raw).first()
    assert (row["key"], row["value"], row["offset"]) == ("1", None, 5)


def test_alert_fan_out(spark, topic, at):
    fill(topic)
    jobs.alert_stream(topic.stream(), at("alerts"), at("ck")).awaitTermination()
    broken = messages(spark, [message('{"event":', 99), message(None, 100)])
    broken.write.mode("append").parquet(at("alerts"))
    files = [os.path.join(at("alerts"), f) for f in os.listdir(at("alerts")) if f.endswith(".parquet")]
    landed = spark.read.schema(MESSAGE).parquet(*files)
    landed.write.parquet(at("topic2"))

    root = at("out")
    sinks = [*fan_out.ALERT_SINKS, fan_out.DEAD_LETTERS]
    stream = landed_stream(spark, at("topic2"))
    fan_out.start_alert_fan_out(stream, root, at("ck2"), sinks).awaitTermination()
    archived = fan_out.archived_alerts(spark, root)
    assert archived.count() == 7
    assert archived.select("date").distinct().collect() == [spark.sql("SELECT current_date()").first()]
    index = {r["doc_id"]: r["humidity"] for r in fan_out.indexed_alerts(spark, root).collect()}
    assert index == {"1-1": 82, "1-3": 90, "0-0": 99, "1-2": 75, "3-1": 88}
    assert fan_out.dead_letters(spark, root).count() == 2


def test_replayed_alert_batch_changes_nothing(spark, at):
    raw = messages(spark, [message(reading(1, n, humidity=90), n) for n in range(3)])
    dated = alerts.parse_alerts(alerts.alert_messages(raw)).selectExpr("*", "DATE '2024-05-06' AS date")
    for _ in range(2):
        fan_out.process_alert_batch(dated, 0, at("out"), "r")
    assert fan_out.archived_alerts(spark, at("out")).count() == 3
    assert fan_out.indexed_alerts(spark, at("out")).count() == 3


def test_observation_stream_numbers_on(spark, at, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def land(poll, first, count):
        lines = [
            '{"current":{"relative_humidity_2m":%d},"ingest_seq":%d,"ingest_ts":"2024-01-01T00:00:00Z"}'
            % (n, n)
            if n % 3
            else '{"ingest_seq":%d}' % n
            for n in range(first, first + count)
        ]
        file = landing / f"{poll}.json"
        file.write_text("\n".join(lines))
        os.utime(file, (1e9 + poll, 1e9 + poll))
        observed.start_observations(
            observation_stream(spark, str(landing)), at("out"), at("ck")
        ).awaitTermination()

    land(0, 1, 4)
    land(1, 5, 4)
    found = parse_readings(observed.observation_messages(spark, at("out"))).collect()
    assert all(r["valid"] and r["station_id"] == 0 for r in found)
    # Numbers follow ingest order over both polls; every third payload left a gap.
    assert sorted((r["s_no"], r["humidity"]) for r in found) == [(n, n) for n in (1, 2, 4, 5, 7, 8)]


def test_random_batches(spark, at):
    """However a topic is cut into micro-batches, the same readings are kept."""
    topic = Topic(spark, at("topic"))
    rng = random.Random(7)
    sent, clock, horizon = [], 0, 600
    for offset in range(400):
        clock += rng.choice([0, 1, 5, 40, 200])
        s_no = 1 if offset % 3 == 0 else rng.randrange(2, 30)
        body = "bad" if rng.random() < 0.05 else reading(1, s_no, humidity=offset % 100)
        sent.append(message(body, offset, arrived=clock))
    cuts = sorted(rng.sample(range(1, 400), 3))
    for a, b in zip([0, *cuts], [*cuts, 400]):
        topic.land(sent[a:b])
    fan_out.start_fan_out(topic.stream(), at("out"), at("ck"), horizon=horizon).awaitTermination()
    assert fan_out.dead_letters(spark, at("out")).count() == sum(m[1] == "bad" for m in sent)
    kept, last = [], {}
    for m in sent:
        if m[1] != "bad":
            body, arrived = json.loads(m[1]), int((m[5] - START).total_seconds())
            if arrived - last.get(body["s_no"], -horizon) >= horizon:
                last[body["s_no"]] = arrived
                kept.append((body["s_no"], body["weather"]["humidity"]))
    archived = fan_out.archived(spark, at("out"))
    assert sorted((r["s_no"], r["humidity"]) for r in archived.collect()) == sorted(kept)
