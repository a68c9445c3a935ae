"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.session import scratch_dir

# A word is a run without blanks, tabs and line ends (space and the code points 9 to 13).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table that is read more than once, and read it back.

    It lies under ``spark.checkpoint.dir``, so it outlives a lost executor, and whatever comes
    after it starts from the file instead of from the texts.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_key(text: Column) -> Column:
    """Tells rows of one ``doc_id`` with different texts apart."""
    return F.xxhash64(text)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once.

    The optimizer may copy a column's expression into each use, also into a function that runs
    for every element of an array; a lambda's variable it leaves alone.
    """
    return F.get(F.transform(F.array(value), then), 0)
