"""Readers of what the sinks wrote, and of files others landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeline.schemas import (
    ALERT_ARCHIVE,
    ALERT_COLUMNS,
    KEY_VALUE,
    OBSERVATION,
    READING_ARCHIVE,
    READING_COLUMNS,
)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived readings.

    Filters on the date pick directories; the rest reach the file scan, where files sorted by
    station skip most rows of others.
    """
    table = spark.read.schema(READING_ARCHIVE).parquet(path)
    return table.select(*READING_COLUMNS, "date")


def read_alert_archive(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.schema(ALERT_ARCHIVE).parquet(path)
    return table.select(*ALERT_COLUMNS, "date")


def read_snapshot_csv(spark: SparkSession, path: str) -> DataFrame:
    """Key/value snapshots: header line, doubled quotes, any line ending, values may span lines.

    Where rows end in CR LF, a CR LF inside a value reads as LF.
    """
    return (
        spark.read.schema(KEY_VALUE)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Landed external payloads, one JSON object per line."""
    return spark.read.schema(OBSERVATION).json(path)


def observation_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(OBSERVATION).json(path)
