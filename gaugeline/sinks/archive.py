"""Parquet archives, one directory per day, sorted by station inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.scalars import event_date
from gaugeline.schemas import ALERT_COLUMNS, READING_COLUMNS

# What an archive is grouped by, and the part of it that makes directories. A directory for every
# station would leave files of a few rows; sorted files let a filter on the station skip.
LAYOUT = ["station_id", "date"]
DIRECTORIES = ["date"]


def dated_readings(readings: DataFrame) -> DataFrame:
    """Archive columns; the date is the day of the event, so late readings go to their own day."""
    return readings.select(*READING_COLUMNS, event_date().alias("date"))


def dated_alerts(alerts: DataFrame, date: Column | None = None) -> DataFrame:
    """Archive columns; an alert carries no time, so its date is the day it is processed."""
    day = F.current_date() if date is None else date
    return alerts.select(*ALERT_COLUMNS, day.alias("date"))


def spread_by_layout(dated: DataFrame) -> DataFrame:
    """Bring rows of one directory together, in pieces of bounded size, sorted by station.

    A plain repartition would give a busy day to one task. A rebalance splits such
    a partition at the advisory size and joins small ones, so files come out neither huge nor
    tiny.
    """
    together = dated.hint("rebalance", *[F.col(c) for c in DIRECTORIES])
    return together.sortWithinPartitions(*DIRECTORIES, "station_id")


def write_archive(dated: DataFrame, path: str, mode: str = "append") -> None:
    writer = spread_by_layout(dated).write.mode(mode).partitionBy(*DIRECTORIES)
    writer.option("compression", "snappy").parquet(path)
