"""Documents replaced by id, and the envelope of those a store turned away."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.scalars import message_id
from gaugeline.operators.ranking import last_per_key
from gaugeline.schemas import ARRIVAL_ORDER


def with_document_id(records: DataFrame) -> DataFrame:
    """Add the stable id that makes writing a record twice harmless."""
    return records.withColumn("doc_id", message_id())


def latest_documents(records: DataFrame, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """One document per id, the last one written."""
    return last_per_key(with_document_id(records), ["doc_id"], order)


def replaced_by(records: DataFrame, newer: Column, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """One document per id from stored and incoming records read together.

    ``newer`` marks the incoming ones, of which the last replaces whatever is stored under its id;
    other ids keep their last stored record. One ranking, and no join of the two sides.
    """
    marked = with_document_id(records).withColumn("_newer", newer)
    return last_per_key(marked, ["doc_id"], ["_newer", *order]).drop("_newer")


def upsert(stored: DataFrame, incoming: DataFrame, key: str = "doc_id") -> DataFrame:
    """As :func:`replaced_by` for two tables with one row per id each."""
    both = stored.withColumn("_newer", F.lit(0)).unionByName(incoming.withColumn("_newer", F.lit(1)))
    return last_per_key(both, [key], ["_newer"]).drop("_newer")


Check = tuple[Column, str]


def with_outcome(records: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Add ``error``: the reason of the first check that fails, NULL when all hold.

    The outcome stays on its row, so nothing is paired up by list position afterwards.
    """
    reason = F.lit(None).cast("string")
    for holds, why in reversed(checks):
        reason = F.when(~F.coalesce(holds, F.lit(False)), F.lit(why)).otherwise(reason)
    return records.withColumn("error", reason)


def accepted_documents(records: DataFrame) -> DataFrame:
    return records.where(F.col("error").isNull()).drop("error")


def rejection_envelopes(
    records: DataFrame, fields: Sequence[str], key: Column, kept: Sequence[str] = ()
) -> DataFrame:
    """Rejected records as dead letters: the reason and the record in one JSON object.

    ``kept`` names columns to carry along, such as the position.
    """
    envelope = F.to_json(F.struct("error", F.struct(*fields).alias("record")))
    rejected = records.where(F.col("error").isNotNull())
    return rejected.select(key.alias("key"), envelope.alias("value"), *kept)
