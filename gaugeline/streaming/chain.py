"""One parse, and a query of its own for every sink.

The intake lands accepted messages, batch after batch, in a table that other streams read. Each
sink follows that table with a checkpoint of its own, so one that fails or is slow holds up no
other and catches up from where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeline.operators.documents import Check
from gaugeline.operators.latest import puts_from_readings
from gaugeline.operators.readings import parse_readings, valid_readings
from gaugeline.schemas import KEY_VALUE, MESSAGE, READING_FLAT
from gaugeline.sinks.keyed import KeyedTable
from gaugeline.sinks.landing import land_batch, landed_batches
from gaugeline.sinks.versions import run_of
from gaugeline.streaming.fan_out import HORIZON_SECONDS, process_batch
from gaugeline.streaming.first_arrivals import first_arrivals
from gaugeline.streaming.jobs import start

ACCEPTED = "accepted"
LATEST_STATE = "latest_state"
ACCEPTED_MESSAGE = T.StructType(
    [*MESSAGE.fields, *READING_FLAT.fields, T.StructField("valid", T.BooleanType())]
)


def start_intake(
    messages: DataFrame, root: str, checkpoint: str, horizon: int = HORIZON_SECONDS, every: str | None = None
) -> StreamingQuery:
    """Parse messages, drop repeats and land the rest, unreadable ones included."""
    rows = first_arrivals(parse_readings(messages), horizon).select(*ACCEPTED_MESSAGE.fieldNames())
    run = run_of(messages.sparkSession, checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        land_batch(batch, f"{root}/{ACCEPTED}", run, batch_id)

    return start(rows.writeStream.foreachBatch(land), checkpoint, every)


def accepted_messages(spark: SparkSession, root: str) -> DataFrame:
    """The stream of what the intake landed."""
    return landed_batches(spark, f"{root}/{ACCEPTED}", ACCEPTED_MESSAGE)


def start_sink(
    spark: SparkSession,
    root: str,
    sink: str,
    checkpoint: str,
    checks: Sequence[Check] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Feed one sink of :mod:`gaugeline.streaming.fan_out` from the intake."""
    step = partial(process_batch, root=root, run=run_of(spark, checkpoint), sinks=(sink,), checks=checks)
    return start(accepted_messages(spark, root).writeStream.foreachBatch(step), checkpoint, every)


def latest_state_table(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, f"{root}/{LATEST_STATE}", KEY_VALUE, "key")


def start_latest_state(
    spark: SparkSession, root: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """The newest value of every key by position, kept in the state store.

    A batch brings only the keys whose value it changed to the table. An older message that comes late
    brings no old value back, which a table replaced batch by batch could not tell.
    """
    puts = puts_from_readings(valid_readings(accepted_messages(spark, root)))
    at = F.struct("partition", "offset")
    newest = puts.groupBy("key").agg(F.max_by("value", at).alias("value"), F.max(at).alias("at"))
    run = run_of(spark, checkpoint)

    def put(changed: DataFrame, batch_id: int) -> None:
        latest_state_table(spark, root).upsert(changed, ["at"], run, batch_id)

    return start(newest.writeStream.outputMode("update").foreachBatch(put), checkpoint, every)
