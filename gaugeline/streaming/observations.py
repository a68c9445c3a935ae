"""Landed external payloads as a stream of reading messages."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gaugeline.operators.observations import normalize_observations
from gaugeline.operators.readings import to_messages
from gaugeline.schemas import KEY_VALUE
from gaugeline.sinks.batches import read_batches, write_batch
from gaugeline.sinks.versions import Versions, run_of
from gaugeline.streaming.jobs import start

MESSAGES = "messages"
PAYLOADS = "payloads"


def process_observations(payloads: DataFrame, batch_id: int, root: str, run: str) -> None:
    """Turn one micro-batch into messages, numbered on from the payloads counted before it."""
    path = f"{root}/{MESSAGES}"
    before = Versions(payloads.sparkSession, path).state()
    if before.has(run, batch_id):
        return
    earlier = before.facts.get(PAYLOADS, 0)
    held = payloads.persist()
    try:
        messages = to_messages(normalize_observations(held, earlier))
        write_batch(messages, path, run, batch_id, facts={PAYLOADS: earlier + held.count()})
    finally:
        held.unpersist()


def start_observations(
    payloads: DataFrame, root: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    step = partial(process_observations, root=root, run=run_of(payloads.sparkSession, checkpoint))
    return start(payloads.writeStream.foreachBatch(step), checkpoint, every)


def observation_messages(spark: SparkSession, root: str) -> DataFrame:
    return read_batches(spark, f"{root}/{MESSAGES}", KEY_VALUE)
