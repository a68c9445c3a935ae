"""Parse nested JSON readings into flat rows and tell good messages from bad ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.json_fields import (
    CORRUPT,
    all_of,
    computed_once,
    fits_int,
    plain_text,
    present,
    read_loose,
    read_typed,
    texts,
    whole_numbers,
)
from gaugeline.schemas import READING_COLUMNS, READING_NESTED

_LONGS = ["station_id", "s_no", "status_timestamp"]
_INTS = ["weather.humidity", "weather.temperature", "weather.wind_speed"]
_TEXT = "battery_status"


def parse_readings(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add the flat reading columns and ``valid``; every message gives exactly one row.

    A message is valid when it is a JSON object with every field. A JSON null or a wrong type
    in a field is accepted and reads as 0 or text; a number too large for its column is not.
    Reading columns of an invalid message are NULL.

    The typed reader settles well-formed readings, nearly all of a real feed. Only the rest
    are read again, leniently.
    """
    numeric = [*_LONGS, *_INTS]
    numbers = {path: f"_numbers[{i}]" for i, path in enumerate(numeric)}
    is_whole = all_of(
        f"_typed.{CORRUPT} IS NULL",
        *[present(f"_typed.{path}") for path in [*numeric, _TEXT]],
        plain_text(f"_typed.{_TEXT}"),
    )
    accepted = all_of(
        f"_loose.{CORRUPT} IS NULL",
        *[present(numbers[path]) for path in _LONGS],
        *[fits_int(numbers[path]) for path in _INTS],
        present("_texts[0]"),
    )
    has_loose = F.col("_loose").isNotNull()
    staged = (
        messages.withColumn("_typed", read_typed(value, READING_NESTED))
        .withColumn("_whole", is_whole)
        .withColumn("_loose", F.when(~F.col("_whole"), read_loose(value, READING_NESTED)))
        .withColumns(
            {
                "_numbers": F.when(has_loose, whole_numbers(*[f"_loose.{p}" for p in numeric])),
                "_texts": F.when(has_loose, texts(f"_loose.{_TEXT}")),
            }
        )
        .withColumn("_accepted", accepted)
    )
    lenient = numbers | {path: f"CAST({numbers[path]} AS INT)" for path in _INTS}
    lenient[_TEXT] = "_texts[0]"
    fields = {
        path.split(".")[-1]: f"CASE WHEN _whole THEN _typed.{path} WHEN _accepted THEN {text} END"
        for path, text in lenient.items()
    }
    ordered = {name: fields[name] for name in READING_COLUMNS}
    reading = computed_once(**ordered, valid="_whole OR _accepted")
    return staged.withColumn("_reading", reading).select(*messages.columns, "_reading.*")


def valid_readings(parsed: DataFrame) -> DataFrame:
    """The good branch, without the raw text."""
    return parsed.where("valid").drop("valid", "value")


def invalid_messages(parsed: DataFrame) -> DataFrame:
    """The dead-letter branch: key and text exactly as they came."""
    return parsed.where(~F.col("valid")).drop("valid", *READING_COLUMNS)


def nested_json() -> Column:
    """Flat reading columns as the nested message text."""
    return F.to_json(
        F.struct(
            "station_id",
            "s_no",
            "battery_status",
            "status_timestamp",
            F.struct("humidity", "temperature", "wind_speed").alias("weather"),
        )
    )


def flat_json() -> Column:
    """Flat reading columns as flat text, in their fixed order."""
    return F.to_json(F.struct(*READING_COLUMNS))


def to_messages(readings: DataFrame) -> DataFrame:
    """Readings as keyed text records, ready for a topic."""
    return readings.select(
        F.col("station_id").cast("string").alias("key"), nested_json().alias("value")
    )
