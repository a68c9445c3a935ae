import pytest
from helpers import rows
from pyspark.sql import functions as F

from gaugeline.functions import scalars
from gaugeline.operators.observations import normalize_observations
from gaugeline.schemas import OBSERVATION
from gaugeline.sources.tables import read_observations


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize("x, expected", [(-0.5, 0), (0.5, 1), (1.5, 2), (-1.5, -1), (2.4, 2), (-2.6, -3)])
def test_half_up(spark, x, expected):
    assert one(spark, str(x), scalars.round_half_up(F.col("x").cast("double"))) == expected


@pytest.mark.parametrize("c, f", [(0, 32), (100, 212), (-40, -40), (21.4, 71), (-17.5, 1), (36.6, 98)])
def test_fahrenheit(spark, c, f):
    assert one(spark, str(c), scalars.celsius_to_fahrenheit(F.col("x").cast("double"))) == f


@pytest.mark.parametrize(
    "raw, key",
    [
        ("plain", "plain"),
        ("/a/b/", "a/b"),
        ("a%20b", "a b"),
        ("a+b", "a b"),
        ("a%2Bb", "a b"),
        ("a%252Bb", "a+b"),
        ("%2Fa%2F", "a"),
        ("%252Fa", "/a"),
        ("caf%C3%A9", "café"),
        ("///", ""),
        ("100%", None),
        ("%zz", None),
    ],
)
def test_decode_key(spark, raw, key):
    assert one(spark, raw, scalars.decode_key(F.col("x"))) == key


def test_json_string(spark):
    import json

    for text in ['a"b\\c\n\t\r\x01é€😀', "", "\x1f", "[x]"]:
        assert json.loads(one(spark, text, scalars.json_string(F.col("x")))) == text


def test_dates_and_paths(spark):
    df = spark.createDataFrame([(7, 1704067199), (7, 1704067200)], "station_id long, status_timestamp long")
    found = df.select(scalars.event_date().alias("d"), scalars.partition_path("base").alias("p"))
    assert [(str(r["d"]), r["p"]) for r in found.collect()] == [
        ("2023-12-31", "base/station_id=7/date=2023-12-31"),
        ("2024-01-01", "base/station_id=7/date=2024-01-01"),
    ]


def test_clock(spark):
    now = spark.range(1).select(
        scalars.epoch_seconds_now().alias("s"), scalars.epoch_millis_now().alias("ms")
    ).first()
    assert abs(now["ms"] / 1000 - now["s"]) < 5


PAYLOADS = [
    '{"current":{"temperature_2m":21.4,"relative_humidity_2m":60,"wind_speed_10m":10.5},"ingest_seq":1,"ingest_ts":"2024-01-01T00:00:00Z"}',
    '{"error":true,"ingest_seq":2,"ingest_ts":"2024-01-01T00:00:01Z"}',
    '{"current":{"temperature_2m":"-17.5","relative_humidity_2m":"61","wind_speed_10m":0.4},"ingest_seq":3,"ingest_ts":"2024-01-01T00:00:02Z"}',
    '{"current":{},"ingest_seq":4,"ingest_ts":"2024-01-01T00:00:03Z"}',
    '{"current":{"temperature_2m":"warm"},"ingest_seq":5,"ingest_ts":"2024-01-01T00:00:04Z"}',
    '{"current":{"relative_humidity_2m":60.5},"ingest_seq":6,"ingest_ts":"2024-01-01T00:00:05Z"}',
    '{"current":{"relative_humidity_2m":60.0},"ingest_seq":7,"ingest_ts":"2024-01-01T00:00:06Z","x":1}',
]


def test_observations(spark, tmp_path):
    (tmp_path / "p.json").write_text("\n".join(PAYLOADS))
    landed = read_observations(spark, str(tmp_path))
    assert landed.schema == OBSERVATION
    base = 1704067200
    assert rows(normalize_observations(landed)) == [
        (0, 1, "high", base, 60, 71, 11),
        (0, 3, "high", base + 2, 61, 1, 0),
        (0, 4, "high", base + 3, 0, 32, 0),
        (0, 7, "high", base + 6, 60, 32, 0),
    ]
