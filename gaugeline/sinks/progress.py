"""How many rows a job handled, counted on the way without another pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, name: str | Observation) -> DataFrame:
    """Count the rows that flow through.

    A batch caller passes an ``Observation`` and asks it after the action. On a stream pass a
    name; each progress report then carries the count under ``observedMetrics``.
    """
    return df.observe(name, F.count(F.lit(1)).alias("rows"))
