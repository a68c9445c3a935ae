"""Numbers a station sent and nobody received."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCKS = 64


def sequence_gaps(
    readings: DataFrame,
    key: str = "station_id",
    number: str = "s_no",
    offset: str = "offset",
    blocks: int = BLOCKS,
) -> DataFrame:
    """Key, run, first, last, missing: every stretch of numbers missing between two received ones.

    A station counts up, and from the start again once it is restarted: a run ends where the number
    falls while the position grows. Equal numbers in a row are copies. What a run lacks before its
    first and after its last number cannot be told from a start or an end there. Rows without a key,
    number or position tell nothing and are left out.

    A window over the key alone would send all rows of a busy one to one task. Rows are compared
    within blocks of the position instead; a block needs one row per key from those before it: their
    last number, and how often it fell.
    """
    told = readings.where(F.col(key).isNotNull() & F.col(number).isNotNull() & F.col(offset).isNotNull())
    shares = F.array(*[F.lit(i / blocks) for i in range(1, blocks)])
    ends = told.agg(F.percentile_approx(offset, shares, 10_000)).scalar()
    passed = [(F.get("_ends", F.lit(i)) < F.col(offset)).cast("int") for i in range(blocks - 1)]
    blocked = (
        told.select(key, number, offset, ends.alias("_ends"))
        .withColumn("_block", reduce(lambda a, b: a + b, passed, F.lit(0)))
        .drop("_ends")
    )
    within = Window.partitionBy(key, "_block").orderBy(offset, number)
    own = blocked.withColumn("_before", F.lag(number).over(within))

    # What a block adds, without the step onto its first row.
    fell = F.count_if(F.col(number) < F.col("_before"))
    at = F.struct(offset, number)
    parts = own.groupBy(key, "_block").agg(
        F.min(at).getField(number).alias("_first"), F.max(at).getField(number).alias("_last"), fell.alias("_falls")
    )
    order = Window.partitionBy(key).orderBy("_block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entered = parts.withColumn("_came", F.lag("_last").over(order))
    entered = entered.withColumn("_step", (F.col("_first") < F.col("_came")).cast("int"))
    start = F.coalesce(F.sum("_falls").over(earlier), F.lit(0)) + F.coalesce(F.sum("_step").over(upto), F.lit(0))
    starts = entered.select(key, "_block", "_came", start.alias("_runs"))

    joined = own.join(starts, [key, "_block"])
    joined = joined.withColumn("_within", F.count_if(F.col(number) < F.col("_before")).over(within))
    before = F.coalesce("_before", "_came")
    return joined.withColumn("_before", before).where(F.col(number) > F.col("_before") + 1).select(
        key,
        (F.col("_runs") + F.col("_within") + 1).cast("bigint").alias("run"),
        (F.col("_before") + 1).alias("first"),
        (F.col(number) - 1).alias("last"),
        (F.col(number) - F.col("_before") - 1).alias("missing"),
    )
