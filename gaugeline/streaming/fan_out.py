"""One pass over the readings topic that feeds every sink, keeping the first copy of an id.

Each micro-batch is parsed once; repeats are told by the state store. Every sink commits a batch under
the run and the batch's number, so one replayed after a failure is skipped by the sinks that
have it, and a stream with a new checkpoint adds to what earlier ones wrote.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeline.functions.scalars import message_id
from gaugeline.operators.alerts import alert_records, parse_alerts, unreadable_alerts
from gaugeline.operators.documents import (
    Check,
    accepted_documents,
    rejection_envelopes,
    with_document_id,
    with_outcome,
)
from gaugeline.operators.latest import puts_from_readings
from gaugeline.operators.readings import invalid_messages, parse_readings, valid_readings
from gaugeline.schemas import (
    ALERT_ARCHIVE,
    ALERT_DOCUMENT,
    ARRIVAL_ORDER,
    DEAD_LETTER,
    KEY_VALUE,
    LONG,
    READING_ARCHIVE,
    READING_COLUMNS,
    READING_DOCUMENT,
)
from gaugeline.sinks.archive import DIRECTORIES, dated_readings, spread_by_layout
from gaugeline.sinks.batches import read_batches, write_batch
from gaugeline.sinks.keyed import KeyedTable
from gaugeline.sinks.versions import run_of
from gaugeline.streaming.first_arrivals import first_arrivals
from gaugeline.streaming.jobs import start

ARCHIVE, DOCUMENTS, LATEST, DEAD_LETTERS = "archive", "documents", "latest", "dead_letters"
ALL_SINKS = (ARCHIVE, DOCUMENTS, LATEST, DEAD_LETTERS)
ALERT_SINKS = (ARCHIVE, DOCUMENTS)
REJECTED = "rejected"

# How long an id is remembered: what 100,000 ids amount to at 45 readings a second.
HORIZON_SECONDS = 40 * 60

DEAD_LETTER_TABLE = T.StructType([*DEAD_LETTER.fields, T.StructField("offset", LONG)])


def document_table(spark: SparkSession, root: str, schema: T.StructType = READING_DOCUMENT) -> KeyedTable:
    return KeyedTable(spark, f"{root}/{DOCUMENTS}", schema, "doc_id")


def latest_table(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, f"{root}/{LATEST}", KEY_VALUE, "key")


def _write_archive(dated: DataFrame, root: str, run: str, batch_id: int) -> None:
    write_batch(spread_by_layout(dated), f"{root}/{ARCHIVE}", run, batch_id, DIRECTORIES)


def _write_dead_letters(letters: DataFrame, path: str, run: str, batch_id: int) -> None:
    write_batch(letters.select("key", "value", "offset"), path, run, batch_id)


def process_batch(
    rows: DataFrame,
    batch_id: int,
    root: str,
    run: str,
    sinks: Collection[str] = ALL_SINKS,
    checks: Sequence[Check] = (),
) -> None:
    """Write one micro-batch of parsed messages, free of repeats, to the wanted sinks.

    A document that fails one of the ``checks`` is not indexed but becomes a dead letter with
    the reason; it stays in the other sinks.
    """
    # A sink reads the batch once; for a single one it need not be held.
    once = len(set(sinks)) == 1 and not checks
    spark, held = rows.sparkSession, rows if once else rows.persist()
    try:
        if DEAD_LETTERS in sinks:
            _write_dead_letters(invalid_messages(held), f"{root}/{DEAD_LETTERS}", run, batch_id)
        accepted = valid_readings(held)
        if ARCHIVE in sinks:
            _write_archive(dated_readings(accepted), root, run, batch_id)
        if DOCUMENTS in sinks:
            judged = with_outcome(accepted, checks)
            wanted = with_document_id(accepted_documents(judged))
            document_table(spark, root).upsert(wanted, ARRIVAL_ORDER, run, batch_id)
            if checks:
                refused = rejection_envelopes(judged, READING_COLUMNS, message_id(), ["offset"])
                _write_dead_letters(refused, f"{root}/{REJECTED}", run, batch_id)
        if LATEST in sinks:
            latest_table(spark, root).upsert(puts_from_readings(accepted), ARRIVAL_ORDER, run, batch_id)
    finally:
        if not once:
            held.unpersist()


def start_fan_out(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    sinks: Collection[str] = ALL_SINKS,
    horizon: int = HORIZON_SECONDS,
    checks: Sequence[Check] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Run :func:`process_batch` on every micro-batch of a message stream.

    A reading is kept if no kept one of its id arrived within ``horizon`` seconds before it,
    in its own batch or an earlier one of the same checkpoint.
    """
    parsed = parse_readings(messages)
    if set(sinks) <= {DEAD_LETTERS}:
        rows = parsed.where(~F.col("valid"))
    else:
        rows = first_arrivals(parsed if DEAD_LETTERS in sinks else parsed.where("valid"), horizon)
    run = run_of(messages.sparkSession, checkpoint)
    step = partial(process_batch, root=root, run=run, sinks=tuple(sinks), checks=checks)
    return start(rows.writeStream.foreachBatch(step), checkpoint, every)


def process_alert_batch(
    parsed: DataFrame, batch_id: int, root: str, run: str, sinks: Collection[str] = ALERT_SINKS
) -> None:
    """Write one micro-batch of parsed, dated alerts to the wanted sinks.

    Alerts are archived as often as they were raised; the index keeps one per id.
    """
    held = parsed.withColumn("value", F.when(~F.col("valid"), F.col("value"))).persist()
    try:
        if DEAD_LETTERS in sinks:
            _write_dead_letters(unreadable_alerts(held), f"{root}/{DEAD_LETTERS}", run, batch_id)
        alerts = alert_records(held)
        if ARCHIVE in sinks:
            _write_archive(alerts.select(*ALERT_ARCHIVE.fieldNames()), root, run, batch_id)
        if DOCUMENTS in sinks:
            table = document_table(parsed.sparkSession, root, ALERT_DOCUMENT)
            table.upsert(with_document_id(alerts), ARRIVAL_ORDER, run, batch_id)
    finally:
        held.unpersist()


def start_alert_fan_out(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    sinks: Collection[str] = ALERT_SINKS,
    every: str | None = None,
) -> StreamingQuery:
    """Run :func:`process_alert_batch` on every micro-batch of an alert topic.

    Unreadable alerts are dropped unless ``sinks`` asks for dead letters. The processing date
    is taken on the stream, where a replayed batch gets its original date again.
    """
    dated = parse_alerts(messages).withColumn("date", F.current_date())
    run = run_of(messages.sparkSession, checkpoint)
    step = partial(process_alert_batch, root=root, run=run, sinks=tuple(sinks))
    return start(dated.writeStream.foreachBatch(step), checkpoint, every)


def archived(spark: SparkSession, root: str) -> DataFrame:
    return read_batches(spark, f"{root}/{ARCHIVE}", READING_ARCHIVE)


def archived_alerts(spark: SparkSession, root: str) -> DataFrame:
    return read_batches(spark, f"{root}/{ARCHIVE}", ALERT_ARCHIVE)


def latest_values(spark: SparkSession, root: str) -> DataFrame:
    return latest_table(spark, root).rows()


def indexed_documents(spark: SparkSession, root: str) -> DataFrame:
    return document_table(spark, root).rows()


def indexed_alerts(spark: SparkSession, root: str) -> DataFrame:
    return document_table(spark, root, ALERT_DOCUMENT).rows()


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    """Messages that could not be read, and documents the index refused."""
    unread = read_batches(spark, f"{root}/{DEAD_LETTERS}", DEAD_LETTER_TABLE)
    return unread.unionByName(read_batches(spark, f"{root}/{REJECTED}", DEAD_LETTER_TABLE))
