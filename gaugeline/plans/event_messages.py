"""The generic ``events`` table seen as a topic of sensor messages.

Each event becomes exactly one message, so the work grows with the table. Some messages are
damaged on purpose, by event number, so that every branch of the parser has rows. The same
definition stands in SQL beside the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeline.sources.messages import READINGS_TOPIC

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

STATIONS = 11
SEQUENCE_LENGTH = 1000
PARTITIONS = 4

TRUNCATED, NO_BATTERY, TEXT_HUMIDITY, FRACTION_HUMIDITY, NULL_WEATHER = range(5)
DAMAGE_PERIOD = 20


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, landing: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).parquet(landing)


def event_readings(events: DataFrame) -> DataFrame:
    """Undamaged readings with their place in the topic."""
    station = f"user_id % {STATIONS}"
    return events.selectExpr(
        f"{station} AS station_id",
        f"event_id % {SEQUENCE_LENGTH} AS s_no",
        """CASE WHEN event_type = 'signup' THEN 'low'
                WHEN event_type IN ('click', 'view') THEN 'medium' ELSE 'high' END
           AS battery_status""",
        "unix_timestamp(CAST(ts AS TIMESTAMP)) AS status_timestamp",
        "CAST(get_json_object(props, '$.k') AS INT) AS humidity",
        "CAST(60 + floor(value) % 60 AS INT) AS temperature",
        "CAST(1 + event_id % 50 AS INT) AS wind_speed",
        f"CAST({station} % {PARTITIONS} AS INT) AS partition",
        "event_id AS offset",
        "CAST(ts AS TIMESTAMP) AS timestamp",
    )


def _json_with_damage() -> str:
    damage = f"offset % {DAMAGE_PERIOD}"
    humidity = f"""CASE {damage} WHEN {TEXT_HUMIDITY} THEN concat('"', humidity, '"')
                        WHEN {FRACTION_HUMIDITY} THEN concat(humidity, '.9')
                        ELSE CAST(humidity AS STRING) END"""
    battery = """concat(',"battery_status":"', battery_status, '"')"""
    weather = f"""concat('{{"humidity":', {humidity}, ',"temperature":', temperature,
                         ',"wind_speed":', wind_speed, '}}')"""
    whole = f"""concat('{{"station_id":', station_id, ',"s_no":', s_no,
                       IF({damage} = {NO_BATTERY}, '', {battery}),
                       ',"status_timestamp":', status_timestamp,
                       ',"weather":', IF({damage} = {NULL_WEATHER}, 'null', {weather}), '}}')"""
    return f"IF({damage} = {TRUNCATED}, substring({whole}, 1, length({whole}) - 20), {whole})"


def event_messages(events: DataFrame) -> DataFrame:
    """The events as raw messages, in topic layout."""
    return event_readings(events).selectExpr(
        "CAST(station_id AS STRING) AS key",
        f"{_json_with_damage()} AS value",
        f"'{READINGS_TOPIC}' AS topic",
        "partition",
        "offset",
        "timestamp",
    )
