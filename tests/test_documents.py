import json

from helpers import message, messages, reading, rows
from pyspark.sql import functions as F

from gaugeline.functions.scalars import message_id
from gaugeline.operators import alerts, documents, readings
from gaugeline.schemas import ALERT_COLUMNS, READING_COLUMNS
from gaugeline.sinks import search


def valid(spark, bodies):
    raw = messages(spark, [message(b, i) for i, b in enumerate(bodies)])
    return readings.valid_readings(readings.parse_readings(raw))


def docs(spark, bodies):
    return documents.latest_documents(valid(spark, bodies)).select("doc_id", *READING_COLUMNS)


def test_upsert_replaces_by_id_and_is_idempotent(spark):
    stored = docs(spark, [reading(1, 1, humidity=10), reading(1, 2, humidity=20)])
    incoming = docs(spark, [reading(1, 2, humidity=21), reading(2, 1), reading(1, 2, humidity=22)])
    once = documents.upsert(stored, incoming)
    assert {(r["doc_id"], r["humidity"]) for r in once.collect()} == {("1-1", 10), ("1-2", 22), ("2-1", 50)}
    assert rows(documents.upsert(once, incoming)) == rows(once)


def test_same_alert_indexed_once_last_wins(spark):
    raw = messages(spark, [message(reading(1, 1, humidity=h), i) for i, h in enumerate([80, 90])])
    parsed = alerts.alert_records(alerts.parse_alerts(alerts.alert_messages(raw)))
    assert parsed.count() == 2
    kept = documents.latest_documents(parsed).select("doc_id", *ALERT_COLUMNS).collect()
    assert [(r["doc_id"], r["humidity"]) for r in kept] == [("1-1", 90)]


def test_rejections_carry_reason_and_record(spark):
    battery = 'l"o\\w'
    records = valid(spark, [reading(1, 1, wind=60, battery=battery), reading(1, 2, wind=60, temp=10), reading(1, 3)])
    judged = documents.with_outcome(
        records, [(F.col("temperature") > 50, 'too "cold"'), (F.col("wind_speed") < 50, "windy")]
    )
    letters = documents.rejection_envelopes(judged, READING_COLUMNS, message_id()).collect()
    found = {r["key"]: json.loads(r["value"]) for r in letters}
    assert found["1-1"]["error"] == "windy" and found["1-2"]["error"] == 'too "cold"'
    assert found["1-1"]["record"]["battery_status"] == battery
    assert list(found["1-1"]["record"]) == READING_COLUMNS
    accepted = documents.accepted_documents(judged)
    assert [r["s_no"] for r in accepted.collect()] == [3]
    assert "error" not in accepted.columns


def test_unknown_check_counts_as_failed(spark):
    records = spark.createDataFrame([(1, None)], "station_id long, s_no long")
    judged = documents.with_outcome(records, [(F.col("s_no") > 0, "no number")])
    assert judged.first()["error"] == "no number"


def test_index_table_is_typed_and_created_once(spark, at):
    search.create_index(spark, "weather_index", at("index"))
    search.create_index(spark, "weather_index", at("index"))
    table = spark.table("weather_index")
    assert dict(table.dtypes)["station_id"] == "bigint"
    assert dict(table.dtypes)["humidity"] == "int"
    docs(spark, [reading()]).write.insertInto("weather_index")
    assert spark.table("weather_index").first()["doc_id"] == "1-1"
    spark.sql("DROP TABLE weather_index")
