"""One row per key, by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.schemas import ARRIVAL_ORDER, READING_KEY


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # Spark turns "row_number = 1" into a group limit on both sides of the shuffle: each task
    # sends at most one row per key, so a key holding a third of the table costs its reducer
    # one row per task. It also beats min_by/max_by over a struct, which cannot hash.
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ARRIVAL_ORDER
) -> DataFrame:
    return _one_per_key(df, keys, [F.asc(c) for c in order])


def last_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ARRIVAL_ORDER
) -> DataFrame:
    return _one_per_key(df, keys, [F.desc(c) for c in order])


def dedup_first(
    readings: DataFrame,
    keys: Sequence[str] = READING_KEY,
    order: Sequence[str] = ARRIVAL_ORDER,
) -> DataFrame:
    """Keep the first arrival of every id.

    A restarted station counts from 1 again, so over a long history the default id repeats
    for different readings. Add ``status_timestamp`` to ``keys`` there, or use
    :func:`dedup_within`.
    """
    return first_per_key(readings, keys, order)


def dedup_within(
    readings: DataFrame,
    horizon: int,
    keys: Sequence[str] = READING_KEY,
    arrival: str = "timestamp",
    order: Sequence[str] = ARRIVAL_ORDER,
    kept: DataFrame | None = None,
) -> DataFrame:
    """Keep an arrival if and only if no kept one of its id lies within ``horizon`` seconds before it.

    A suppressed copy does not prolong the suppression, and nothing is dropped for being late.
    ``kept`` has arrivals kept before (the keys and ``arrived``, in seconds); one with a clock
    ahead suppresses nothing before it. Arrivals without a time cannot be compared: the first of
    an id is kept.

    An id shrinks to one row per second in each task, and is cut at pauses of a horizon, where
    nothing carries over. What is left of an id in one group is at most a row per second of
    arrivals that follow each other without such a pause.
    """
    names = readings.columns
    firsts = first_per_key(
        readings.withColumn("_second", F.unix_timestamp(arrival)), [*keys, "_second"], order
    )
    # At equal seconds an arrival kept before comes first.
    rows = firsts.select(*keys, "_second", F.lit(1).alias("_new"), F.struct(*names).alias("_row"))
    if kept is not None:
        known = kept.select(*keys, F.col("arrived").alias("_second"), F.lit(0).alias("_new"))
        rows = rows.unionByName(known.withColumn("_row", F.lit(None)))
    of_id = Window.partitionBy(*keys).orderBy(F.col("_second").asc_nulls_first(), "_new")
    pause = F.col("_second") - F.lag("_second").over(of_id) >= horizon
    runs = rows.withColumn("_pause", F.coalesce(pause, F.lit(True)).cast("int"))
    runs = runs.withColumn("_run", F.sum("_pause").over(of_id))
    grouped = runs.groupBy(*keys, "_run").agg(
        F.collect_list(F.struct("_second", "_new", "_row")).alias("_found")
    )
    steps = F.array_sort("_found", _by_time)

    def step(state, found):
        free = state["last"].isNull() | (found["_second"] - state["last"] >= horizon)
        new = found["_new"] == 1
        accepted = F.when(new & (free | found["_second"].isNull()), F.array(found["_row"]))
        moved = F.when(~new | free, F.coalesce(found["_second"], state["last"])).otherwise(state["last"])
        return F.struct(
            moved.alias("last"), F.concat(state["rows"], F.coalesce(accepted, none)).alias("rows")
        )

    row_type = rows.schema["_row"].dataType.simpleString()
    none = F.array().cast(f"array<{row_type}>")
    start = F.struct(F.lit(None).cast("bigint").alias("last"), none.alias("rows"))
    chosen = grouped.select(F.explode(F.aggregate(steps, start, step)["rows"]).alias("_row"))
    return chosen.select(*[F.col(f"_row.`{c}`").alias(c) for c in names])


def _by_time(a: Column, b: Column) -> Column:
    """Earlier first, at equal seconds what was kept before."""
    a_at, b_at = F.coalesce(a["_second"], F.lit(-(2**62))), F.coalesce(b["_second"], F.lit(-(2**62)))
    later = (a_at > b_at) | ((a_at == b_at) & (a["_new"] > b["_new"]))
    earlier = (a_at < b_at) | ((a_at == b_at) & (a["_new"] < b["_new"]))
    return F.when(later, 1).when(earlier, -1).otherwise(0)
