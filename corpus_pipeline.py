"""A corpus pipeline; each stage's result is written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugeline.llm import stages
from gaugeline.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.drop_toxic),
    ("near_duplicates", stages.drop_near_duplicates),
    ("secrets", stages.scan_secrets),
    ("mix", stages.mix_sources),
    ("pack", stages.pack_sequences),
]

# SQL has neither the tokenizer nor the trained classifier.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that its predecessor kept; the last result is returned unwritten."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
