"""Readers of keyed text records. The operators only need the columns, not the transport."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.schemas import MESSAGE

# Topic names.
READINGS_TOPIC = "weather_status"
ALERTS_TOPIC = "rain_alerts"
DEAD_LETTER_TOPIC = "invalid-messages"


def kafka_records(raw: DataFrame) -> DataFrame:
    """The broker connector's columns as text records."""
    return raw.select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        *[F.col(name) for name in MESSAGE.fieldNames()[2:]],
    )


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, max_records: int | None = None
) -> DataFrame:
    """A topic as a stream, from its beginning; the checkpoint takes over after a restart.

    ``max_records`` bounds one micro-batch. Needs the Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_records is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return kafka_records(reader.load())


def kafka_table(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything a topic holds now, as a batch."""
    raw = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )
    return kafka_records(raw)


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = MESSAGE,
    max_files: int | None = None,
) -> DataFrame:
    """Records landed as Parquet files, as a stream in order of file age."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def landed_table(spark: SparkSession, path: str, schema: T.StructType = MESSAGE) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
