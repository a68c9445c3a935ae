"""Micro-batches landed for other streams to read, each a directory that appears at once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeline.sinks.versions import Files, VersionTaken


def land_batch(rows: DataFrame, path: str, run: str, batch_id: int) -> bool:
    """Write a batch aside and rename it into place, unless this run has landed it before."""
    files, name = Files(rows.sparkSession, path), f"{run}-{batch_id:012d}"
    if files.exists(name):
        return False
    aside = f"{path.rstrip('/')}-aside/{uuid.uuid4().hex}"
    rows.write.parquet(aside)
    files.system.mkdirs(files._path(""))
    try:
        files.move(f"../{aside.rsplit('/', 2)[-2]}/{aside.rsplit('/', 1)[-1]}", name)
    except VersionTaken:
        return False
    return True


def landed_batches(spark: SparkSession, path: str, schema: T.StructType, per_batch: int | None = None) -> DataFrame:
    """A stream of what is landed, and of what will be."""
    files = Files(spark, path)
    files.system.mkdirs(files._path(""))
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(path)
