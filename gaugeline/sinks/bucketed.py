"""An index as a catalogue table in buckets by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.schemas import READING_DOCUMENT

BUCKETS = 16


def create_bucketed_index(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType = READING_DOCUMENT,
    key: str = "doc_id",
    buckets: int = BUCKETS,
) -> None:
    """Declare the table with its typed columns, bucketed and sorted by ``key``, unless it is there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{path}' "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
    )


def fill(documents: DataFrame, table: str, key: str = "doc_id", buckets: int = BUCKETS) -> None:
    """Append rows, one task per bucket, so a bucket gets one file."""
    columns = documents.sparkSession.table(table).columns
    documents.select(*columns).repartition(buckets, key).write.insertInto(table)


def upserted(spark: SparkSession, stored: str, incoming: str, key: str = "doc_id") -> DataFrame:
    """Two tables with one row per id as one: an incoming row replaces the stored one of its id.

    Meant for tables in the same number of buckets; that no exchange is planned is not yet so.
    """
    old, new = spark.table(stored).alias("old"), spark.table(incoming).alias("new")
    both = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    came = F.col(f"new.{key}").isNotNull()
    return both.select(
        *[F.when(came, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in spark.table(stored).columns]
    )
