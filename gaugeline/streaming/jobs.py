"""Streaming queries. Each has its own checkpoint and can be stopped and resumed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from gaugeline.operators.alerts import HUMIDITY_THRESHOLD, rain_alerts, to_alert_messages


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start a query: in steps of ``every``, or until the source is drained."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def alert_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    threshold: int = HUMIDITY_THRESHOLD,
    every: str | None = None,
) -> StreamingQuery:
    """Raw messages to alert messages. Reads the raw topic: repeats raise alerts again."""
    alerts = to_alert_messages(rain_alerts(messages, threshold))
    return start(alerts.writeStream.format("parquet").option("path", path), checkpoint, every)


def console_stream(
    dead_letters: DataFrame, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Print dead letters as they come."""
    return start(dead_letters.writeStream.format("console"), checkpoint, every)


def publish_stream(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Send keyed records to a topic. Needs the Kafka connector on the class path."""
    writer = (
        messages.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
    )
    return start(writer, checkpoint, every)
