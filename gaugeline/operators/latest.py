"""Latest value per key, kept as an append-only log of puts.

A put is a row of :data:`gaugeline.schemas.PUT_LOG`. Position ``(file_id, offset)`` decides
which put is newer, never the clock: two puts in one millisecond, or a clock set back, must
not bring an old value back. There is no delete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.operators.ranking import last_per_key
from gaugeline.operators.readings import flat_json

POSITION = ["file_id", "offset"]


def puts_from_readings(readings: DataFrame) -> DataFrame:
    """Readings as puts: key is the station, value the flat JSON text. Other columns stay."""
    return readings.select(
        F.col("station_id").cast("string").alias("key"),
        flat_json().alias("value"),
        *[c for c in readings.columns if c in ("partition", "offset", "timestamp")],
    )


def replay(log: DataFrame) -> DataFrame:
    """The newest put of every key, as recovering from the whole log leaves it."""
    return last_per_key(log, ["key"], POSITION)


def snapshot(log: DataFrame) -> DataFrame:
    """Every key with its value."""
    return replay(log).select("key", "value")


def get(log: DataFrame, key: str) -> DataFrame:
    """The row of one key, or none. The filter on the key goes below the ranking."""
    return snapshot(log.where(F.col("key") == key))


def get_many(log: DataFrame, requests: DataFrame) -> DataFrame:
    """Every requested key with its value, NULL where there is none.

    The requests pick the puts before they are ranked; the optimizer sends a short list to
    every task.
    """
    asked = requests.select("key")
    return asked.join(snapshot(log.join(asked, "key", "left_semi")), "key", "left")
