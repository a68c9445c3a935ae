"""A table with one row per key, replaced by key: hash buckets, copied when written.

Rows lie in the bucket of their key, sorted by it. A batch reads and rewrites the buckets it has
keys for and no others; a version names the live directory of every bucket. So reading ranks
nothing, and one key is one bucket, whose row groups its Parquet statistics and Bloom filter narrow
down further.

What a batch costs is the size of the buckets it touches. Buckets should hold what a task writes at once
(some hundred MB); a batch of random keys that outnumber the buckets rewrites the table, so such a
table wants long batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.operators.documents import upsert
from gaugeline.operators.ranking import last_per_key
from gaugeline.sinks.batches import DATA, GRACE_SECONDS
from gaugeline.sinks.versions import State, Versions

BUCKETS = 64
BUCKET = "bucket"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class KeyedTable:
    """``schema`` has the ``key`` column. The number of buckets is fixed when the table is first written."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.key = spark, path, schema, key
        self.versions, self._buckets = Versions(spark, path), buckets

    def _read(self, directories: Sequence[str]) -> DataFrame:
        if not directories:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/{d}" for d in directories]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _buckets_of(self, state: State) -> int:
        return state.facts.get("buckets", self._buckets)

    def upsert(self, rows: DataFrame, order: Sequence[str], run: str, batch_id: int) -> bool:
        """Replace by key: of a batch's rows of a key the last by ``order`` wins, and over what is
        stored in any case. A batch this run has committed is skipped; says whether it was written.
        One writer at a time: a second one fails at its commit and changes nothing.
        """
        before = self.versions.state()
        if before.has(run, batch_id):
            return False
        buckets = self._buckets_of(before)
        newest = last_per_key(rows, [self.key], order).select(*self.schema.fieldNames()).persist()
        try:
            found = newest.select(bucket_of(F.col(self.key), buckets).alias(BUCKET)).distinct().collect()
            touched = sorted(str(r[BUCKET]) for r in found)  # at most one row per bucket
            directory = f"{DATA}/{run}-{batch_id}-{uuid.uuid4().hex[:8]}"
            if touched:
                stored = self._read([before.live[b] for b in touched if b in before.live])
                self._write(upsert(stored, newest, self.key), buckets, len(touched), directory)
        finally:
            newest.unpersist()
        live = {b: f"{directory}/{BUCKET}={b}" for b in touched}
        self.versions.commit(before, live, run, batch_id, facts={"buckets": buckets})
        return True

    def _write(self, rows: DataFrame, buckets: int, tasks: int, directory: str) -> None:
        dealt = rows.withColumn(BUCKET, bucket_of(F.col(self.key), buckets)).repartition(tasks, BUCKET)
        writer = dealt.sortWithinPartitions(BUCKET, self.key).write.partitionBy(BUCKET)
        writer.option(f"parquet.bloom.filter.enabled#{self.key}", "true").parquet(f"{self.path}/{directory}")

    def rows(self) -> DataFrame:
        """The table as it is: one row per key, and nothing to rank."""
        return self._read(list(self.versions.state().live.values()))

    def get(self, key) -> DataFrame:
        """The row of one key, or none: the one bucket that can have it."""
        state = self.versions.state()
        kind = self.schema[self.key].dataType
        wanted = F.lit(key).cast(kind)
        at = self.spark.range(1).select(bucket_of(wanted, self._buckets_of(state))).first()[0]
        return self._read([d for b, d in state.live.items() if b == str(at)]).where(F.col(self.key) == wanted)

    def get_many(self, requests: DataFrame) -> DataFrame:
        """Every requested key with its row, NULL where there is none; reads the buckets asked for."""
        state = self.versions.state()
        asked = requests.select(F.col(self.key))
        some = asked.select(bucket_of(F.col(self.key), self._buckets_of(state)).alias(BUCKET)).distinct()
        at = {str(r[BUCKET]) for r in some.where(F.col(BUCKET).isNotNull()).collect()}
        there = self._read([d for b, d in state.live.items() if b in at])
        return asked.join(there, self.key, "left")

    def clean(self, older_than: float = GRACE_SECONDS) -> list[str]:
        """Delete directories no bucket lies in any more."""
        return self.versions.clean(DATA, older_than)
