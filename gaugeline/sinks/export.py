"""Snapshots handed out as CSV or JSON, and records handed to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions.scalars import json_string


def export_csv(snapshot: DataFrame, path: str, line_end: str = "\n") -> None:
    """Write ``key,value`` files. A small snapshot is one file, a large one several.

    The rebalance picks the number from the size at run time, so no snapshot has to pass
    through one task. ``line_end`` may be ``"\\r\\n"`` for values of one line each; the writer
    would also put it in place of line feeds inside values.
    """
    (
        snapshot.select("key", "value")
        .hint("rebalance")
        .write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("lineSep", line_end)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def snapshot_json(snapshot: DataFrame, objects: int = 1) -> DataFrame:
    """The snapshot as ``objects`` JSON objects, always that many: ``{}`` where no key falls.

    Keys are unique and spread by hash, so the objects together hold every key once. An object
    is made in one task; ask for as many as make one fit.
    """
    member = F.concat(json_string(F.col("key")), F.lit(":"), json_string(F.col("value")))
    members = snapshot.select(
        F.pmod(F.xxhash64("key"), F.lit(objects)).cast("int").alias("object_id"),
        F.struct(F.col("key"), member.alias("member")).alias("entry"),
    )
    ordered = F.sort_array(F.collect_list("entry"))["member"]
    bodies = members.groupBy("object_id").agg(F.concat_ws(",", ordered).alias("body"))
    every = snapshot.sparkSession.range(objects).select(F.col("id").cast("int").alias("object_id"))
    body = F.concat(F.lit("{"), F.coalesce("body", F.lit("")), F.lit("}"))
    return every.join(bodies, "object_id", "left").select("object_id", body.alias("json"))


def json_entries(objects: DataFrame, column: str) -> DataFrame:
    """The members of JSON objects as key/value rows, the last of a repeated key. Other columns stay."""
    as_map = F.from_json(column, T.MapType(T.StringType(), T.StringType()))
    # A parsed map holds repeated keys; building it again keeps the last (see session settings).
    kept = [c for c in objects.columns if c != column]
    return objects.select(*kept, F.explode(F.map_from_entries(F.map_entries(as_map))))


def publish_table(messages: DataFrame, servers: str, topic: str) -> None:
    """Send keyed records to a topic. Needs the Kafka connector on the class path."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
