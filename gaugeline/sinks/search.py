"""Document indexes: the typed table, and the optional external search store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeline.schemas import READING_DOCUMENT

# Index names.
READINGS_INDEX = "weather-statuses"
ALERTS_INDEX = "rain-alerts"


def create_index(
    spark: SparkSession, table: str, path: str, schema: T.StructType = READING_DOCUMENT
) -> None:
    """Declare the index table with its typed columns, unless it is there already."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{path}'")


def publish_documents(documents: DataFrame, index: str, nodes: str) -> None:
    """Write documents to a search store, replacing by ``doc_id``. Needs its connector."""
    (
        documents.write.format("es")
        .mode("append")
        .option("es.nodes", nodes)
        .option("es.mapping.id", "doc_id")
        .option("es.mapping.exclude", "doc_id")
        .save(index)
    )
