"""Tables a stream appends to: Parquet, one directory per micro-batch, made live by a version.

A batch replayed under its run is skipped; a run with a new checkpoint adds. Nothing is replaced, and
readers see a batch as a whole or not at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeline.sinks.versions import Versions, VersionTaken

DATA = "data"
TRIES = 5
# Unnamed directories are left alone for this long: a writer may still be at work on them.
GRACE_SECONDS = 24 * 3600


def write_batch(
    rows: DataFrame,
    path: str,
    run: str,
    batch_id: int,
    by: Sequence[str] = (),
    facts: dict[str, int] | None = None,
) -> bool:
    """Append a batch unless this run has committed it before; says whether it was written.

    ``facts`` are kept with the version. They follow from the one before, so with them a second writer
    fails instead of trying again.
    """
    versions = Versions(rows.sparkSession, path)
    before = versions.state()
    if before.has(run, batch_id):
        return False
    directory = f"{DATA}/batch={run}-{batch_id}-{uuid.uuid4().hex[:8]}"
    rows.write.partitionBy(*by).parquet(f"{path}/{directory}")
    for turn in range(TRIES):
        try:
            # Appends never conflict with what others append; only the number is taken.
            versions.commit(before, {directory: directory}, run, batch_id, facts=facts)
            return True
        except VersionTaken:
            if facts is not None or turn == TRIES - 1:
                raise
            before = versions.state()
    return True


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All committed batches. Before the first one there are no rows."""
    live = Versions(spark, path).state().live
    if not live:
        return spark.createDataFrame([], schema)
    return _rows(spark, path, live.values(), schema)


def _rows(spark: SparkSession, path: str, directories: Iterable[str], schema: T.StructType) -> DataFrame:
    reader = spark.read.schema(schema).option("basePath", f"{path}/{DATA}")
    return reader.parquet(*[f"{path}/{d}" for d in directories]).select(*schema.fieldNames())


def compact_batches(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str] = ()) -> int:
    """Rewrite the batches of now as one directory of even files; returns how many there were.

    Readers go over from the old directories to the new one in a single step. Batches committed
    meanwhile stay as they are; of two compactions at once the second fails.
    """
    versions = Versions(spark, path)
    before = versions.state()
    if len(before.live) < 2:
        return len(before.live)
    directory = f"{DATA}/batch=compact-{before.version}-{uuid.uuid4().hex[:8]}"
    rows = _rows(spark, path, before.live.values(), schema)
    rows.hint("rebalance", *by).write.partitionBy(*by).parquet(f"{path}/{directory}")
    now = versions.state()
    for turn in range(TRIES):
        if not set(before.live) <= set(now.live):
            raise RuntimeError("the table was compacted meanwhile")
        try:
            versions.commit(now, {directory: directory}, gone=list(before.live))
            return len(before.live)
        except VersionTaken:
            if turn == TRIES - 1:
                raise
            now = versions.state()
    return len(before.live)


def clean(spark: SparkSession, path: str, older_than: float = GRACE_SECONDS) -> list[str]:
    """Delete what failed attempts and compactions left behind."""
    return Versions(spark, path).clean(DATA, older_than)
