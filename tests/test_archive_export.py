import csv
import glob
import json

import pytest
from helpers import as_dict, message, messages, plan, reading, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from gaugeline.operators import alerts, readings
from gaugeline.schemas import READING_COLUMNS
from gaugeline.sinks import archive, export
from gaugeline.sinks.progress import counted
from gaugeline.sources import tables

DAY = 86400
BASE = 1704067200  # 2024-01-01


def valid(spark, bodies):
    raw = messages(spark, [message(b, i) for i, b in enumerate(bodies)])
    return readings.valid_readings(readings.parse_readings(raw))


@pytest.fixture
def archived(spark, at):
    bodies = [reading(s, n, time=BASE + n * DAY // 2) for s in (1, 10) for n in range(6)]
    archive.write_archive(archive.dated_readings(valid(spark, bodies)), at("archive"))
    return at("archive")


def test_layout_and_types(spark, archived):
    found = glob.glob(f"{archived}/date=*/*.snappy.parquet")
    assert {p.split("/")[-2] for p in found} == {f"date=2024-01-0{d}" for d in (1, 2, 3)}
    assert len(found) == 3
    table = tables.read_archive(spark, archived)
    assert table.columns == [*READING_COLUMNS, "date"]
    assert dict(table.dtypes)["station_id"] == "bigint"
    assert table.count() == 12
    assert table.where("date = DATE '2024-01-02'").count() == 4


def test_filters_reach_the_scan(spark, archived):
    table = tables.read_archive(spark, archived)
    shown = plan(
        table.where((F.col("station_id") == 10) & (F.col("date") > "2024-01-01") & (F.col("s_no") > 3))
        .select("s_no", "humidity")
    )
    scan = next(l for l in shown.splitlines() if "FileScan" in l)
    assert "date" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "GreaterThan(s_no,3)" in scan and "EqualTo(station_id,10)" in scan
    assert scan.split("ReadSchema:")[1].strip() == "struct<station_id:bigint,s_no:bigint,humidity:int>"


def test_appending_and_late_readings(spark, archived):
    late = valid(spark, [reading(1, 99, time=BASE - 30 * DAY)])
    archive.write_archive(archive.dated_readings(late), archived)
    table = tables.read_archive(spark, archived)
    assert table.count() == 13
    assert table.where("date = DATE '2023-12-02'").first()["s_no"] == 99


def test_busy_directory_is_split(spark, at):
    """Rows of one station and day may be written by several tasks."""
    bodies = spark.range(200_000).select(
        F.lit(1).cast("long").alias("station_id"), F.col("id").alias("s_no"),
        F.sha2(F.col("id").cast("string"), 256).alias("battery_status"),
        F.lit(BASE).cast("long").alias("status_timestamp"),
        *[F.lit(1).alias(c) for c in ("humidity", "temperature", "wind_speed")],
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "1m")
    try:
        archive.write_archive(archive.dated_readings(bodies), at("busy"))
    finally:
        spark.conf.unset(setting)
    assert len(glob.glob(at("busy") + "/date=2024-01-01/*.parquet")) > 1
    assert tables.read_archive(spark, at("busy")).count() == 200_000


def test_alerts_are_dated_by_processing(spark, at):
    raw = messages(spark, [message(reading(2, 5, time=BASE, humidity=90))])
    records = alerts.alert_records(alerts.parse_alerts(alerts.alert_messages(raw)))
    archive.write_archive(archive.dated_alerts(records), at("today"))
    today = spark.sql("SELECT current_date()").first()[0]
    assert tables.read_alert_archive(spark, at("today")).first()["date"] == today
    given = archive.dated_alerts(records, F.lit("2030-05-06").cast("date"))
    archive.write_archive(given, at("given"))
    assert glob.glob(at("given") + "/date=2030-05-06/*.parquet")


AWKWARD = {
    "1": '{"station_id":1,"battery_status":"low"}',
    "plain": "0,10",
    "quotes": 'say "hi", \\ and \\"',
    "lines": "a\nb\r\nc\n",
    "spaces": "  x  ",
    "unicode": "é€😀",
}


def test_csv_round_trip_and_other_readers(spark, at):
    snapshot = spark.createDataFrame(list(AWKWARD.items()), "key string, value string")
    export.export_csv(snapshot, at("csv"))
    assert as_dict(tables.read_snapshot_csv(spark, at("csv"))) == AWKWARD
    files = glob.glob(at("csv") + "/*.csv")
    assert len(files) == 1
    with open(files[0], newline="") as f:
        assert f.readline() == "key,value\n"
        f.seek(0)
        assert {r["key"]: r["value"] for r in csv.DictReader(f)} == AWKWARD


def test_csv_line_end(spark, at):
    snapshot = spark.createDataFrame([("1", '{"a":1}')], "key string, value string")
    export.export_csv(snapshot, at("csv"), line_end="\r\n")
    with open(glob.glob(at("csv") + "/*.csv")[0], newline="") as f:
        assert f.read() == 'key,value\r\n1,"{""a"":1}"\r\n'


def test_reads_foreign_csv(spark, at):
    with open(at("snap.csv"), "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(["key", "value"])
        writer.writerows(AWKWARD.items())
    with open(at("empty.csv"), "w", newline="") as f:
        f.write("key,value\r\n")
    expected = AWKWARD | {"lines": AWKWARD["lines"].replace("\r\n", "\n")}
    assert as_dict(tables.read_snapshot_csv(spark, at("snap.csv"))) == expected
    assert tables.read_snapshot_csv(spark, at("empty.csv")).count() == 0


def test_snapshot_as_as_many_objects_as_asked_for(spark):
    snapshot = spark.createDataFrame(list(AWKWARD.items()), "key string, value string")
    one = export.snapshot_json(snapshot).collect()
    assert len(one) == 1 and json.loads(one[0]["json"]) == AWKWARD
    several = export.snapshot_json(snapshot, objects=20)
    parts = [json.loads(r["json"]) for r in several.collect()]
    assert len(parts) == 20 and {} in parts
    assert sum(map(len, parts)) == len(AWKWARD)
    assert {k: v for p in parts for k, v in p.items()} == AWKWARD
    assert as_dict(export.json_entries(several.drop("object_id"), "json")) == AWKWARD


@pytest.mark.parametrize("objects", [1, 3])
def test_empty_snapshot(spark, at, objects):
    nothing = spark.createDataFrame([], "key string, value string")
    found = export.snapshot_json(nothing, objects).collect()
    assert [(r["object_id"], r["json"]) for r in found] == [(i, "{}") for i in range(objects)]
    export.export_csv(nothing, at("csv"))
    assert tables.read_snapshot_csv(spark, at("csv")).count() == 0


def test_entries_keep_the_last_of_a_repeated_key(spark):
    text = '{"a":"1","b":{"c":[1,2]},"a":null,"d":null,"a":"3","e":1.50}'
    objects = spark.createDataFrame([(1, text), (2, "{}"), (3, None), (4, "no object")], "n int, json string")
    found = rows(export.json_entries(objects, "json"))
    assert found == sorted([(1, "a", "3"), (1, "b", '{"c":[1,2]}'), (1, "d", None), (1, "e", "1.5")], key=repr)


def test_counting_on_the_way(spark):
    seen = Observation("indexed")
    counted(spark.range(7), seen).write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 7
    assert rows(counted(spark.range(2), "named")) == [(0,), (1,)]
