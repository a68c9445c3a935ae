"""External observations turned into readings of station 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.scalars import celsius_to_fahrenheit, round_half_up
from gaugeline.operators.sequence import sequence_numbers
from gaugeline.schemas import READING_COLUMNS

# The station external data counts as, and its battery state.
EXTERNAL_STATION = 0
EXTERNAL_BATTERY = "high"


def _number(name: str) -> tuple[Column, Column]:
    """A payload number, 0 when absent, and whether its text is usable at all."""
    text = F.col(f"current.{name}")
    number = text.try_cast("double")
    return F.coalesce(number, F.lit(0.0)), text.isNull() | number.isNotNull()


def normalize_observations(observations: DataFrame, earlier: int = 0) -> DataFrame:
    """Readings from payloads in :data:`gaugeline.schemas.OBSERVATION` layout.

    Every payload takes a sequence number in ingest order, after the ``earlier`` ones that
    came before this table; one that cannot be used then gives no reading, which leaves a gap
    as a lost message does.
    """
    placed = observations.withColumn("_source", F.lit(0)).withColumn(
        "station_id", F.lit(EXTERNAL_STATION).cast("bigint")
    )
    numbered = sequence_numbers(placed, partition="_source", offset="ingest_seq")
    humidity, humidity_ok = _number("relative_humidity_2m")
    celsius, celsius_ok = _number("temperature_2m")
    wind, wind_ok = _number("wind_speed_10m")
    usable = F.col("current").isNotNull() & humidity_ok & celsius_ok & wind_ok
    usable = usable & (humidity == F.floor(humidity))
    return numbered.where(usable).select(
        "station_id",
        (F.col("s_no") + F.lit(earlier)).alias("s_no"),
        F.lit(EXTERNAL_BATTERY).alias("battery_status"),
        F.unix_timestamp("ingest_ts").alias("status_timestamp"),
        humidity.cast("int").alias("humidity"),
        celsius_to_fahrenheit(celsius).alias("temperature"),
        round_half_up(wind).alias("wind_speed"),
    ).select(*READING_COLUMNS)
