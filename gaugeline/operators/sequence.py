"""Running numbers per key that do not put one key into one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Blocks of the order. Each is numbered by itself.
BLOCKS = 64


def sequence_numbers(
    df: DataFrame,
    key: str = "station_id",
    partition: str = "partition",
    offset: str = "offset",
    name: str = "s_no",
    blocks: int = BLOCKS,
) -> DataFrame:
    """Number the rows of each key from 1 in (partition, offset) order, NULL first.

    A window over the key alone would send all rows of a busy key to one task. Rows are
    numbered within blocks instead, and each block adds the rows its key has in earlier ones, which
    takes one small row per block. Blocks end at quantiles of the offset, so they hold alike many
    rows however sparse the offsets are. Rows without an offset are one block, and rows without
    a key are a key.
    """
    shares = F.array(*[F.lit(i / blocks) for i in range(blocks)])
    ends = df.agg(F.percentile_approx(offset, shares, 10_000)).scalar()
    passed = [(F.get("_ends", F.lit(i)) < F.col(offset)).cast("int") for i in range(blocks)]
    block = F.when(F.col(offset).isNull(), -1).otherwise(reduce(Column.__add__, passed))
    parts = [key, partition, "_block"]
    blocked = df.withColumn("_ends", ends).withColumn("_block", block).drop("_ends")

    sizes = blocked.groupBy(*parts).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = (
        Window.partitionBy(key)
        .orderBy(F.col(partition).asc_nulls_first(), "_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    starts = sizes.select(*[F.col(c).alias(f"_at{i}") for i, c in enumerate(parts)], start)

    order = Window.partitionBy(*parts).orderBy(F.col(offset).asc_nulls_first())
    same = reduce(
        Column.__and__, [F.col(c).eqNullSafe(F.col(f"_at{i}")) for i, c in enumerate(parts)]
    )
    numbered = blocked.withColumn("_within", F.row_number().over(order)).join(starts, same)
    return numbered.select(
        *df.columns, (F.col("_start") + F.col("_within")).cast("bigint").alias(name)
    )
