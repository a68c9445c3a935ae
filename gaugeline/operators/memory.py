"""Repeats told by a memory of the last ids, however long ago they came."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.schemas import ARRIVAL_ORDER, READING_KEY

LANES = 64
# A stretch of the topic is 2 to this many offsets, which are dense, so rows compared in one group are bounded.
STRETCH_BITS = 16


def lane_of(keys: Sequence[str], lanes: int) -> Column:
    """The lane of an id: the first 32 bits of the md5 of its parts, modulo ``lanes``."""
    digits = F.substring(F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in keys])), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % lanes


def dedup_last_n(
    readings: DataFrame,
    size: int,
    lanes: int = LANES,
    keys: Sequence[str] = READING_KEY,
    order: Sequence[str] = ARRIVAL_ORDER,
) -> DataFrame:
    """Keep an arrival unless its id is among the last ``size`` kept ids of its lane.

    A memory forgets the oldest id it holds when one more comes in. Being asked for does not keep an id
    young, so a repeated id passes again once ``size`` others were kept after it. Every decision
    hangs on those before it; a hash deals ids to ``lanes`` memories that know nothing of each other,
    so that lanes are decided side by side. One lane is one memory for all, in one task. Null parts of an id
    are values like others. The last column of ``order`` is a running whole number, as offsets are.

    A task holds ``size`` ids, however many rows pass through it. A copy that follows its own id in the
    lane changes nothing and goes before lanes are put together, stretch by stretch of the topic.
    So an id with a third of all rows leaves no more rows in its lane than the other ids there, and
    one for each stretch.
    """
    if size < 1 or lanes < 1:
        raise ValueError("a memory holds one id at least, and there is one at least")
    names = readings.columns
    *major, running = order
    stretch = F.shiftright(running, STRETCH_BITS)
    dealt = readings.withColumns({"_lane": lane_of(keys, lanes), "_stretch": stretch, "_id": F.struct(*keys)})
    follows = Window.partitionBy("_lane", *major, "_stretch").orderBy(F.asc(running), "_id")
    changed = dealt.withColumn("_before", F.lag("_id").over(follows))
    changed = changed.where(~F.col("_before").eqNullSafe(F.col("_id"))).select(*names, "_lane")
    lined_up = changed.repartition("_lane").sortWithinPartitions("_lane", *[F.asc(c) for c in order], *keys)
    return lined_up.mapInArrow(_remembering(size, list(keys), names), readings.schema)


def _remembering(size: int, keys: list[str], names: list[str]):
    def unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, memory = None, OrderedDict()
        for batch in batches:
            new = []
            ids = zip(*[batch.column(k).to_pylist() for k in keys])
            for at, id_ in zip(batch.column("_lane").to_pylist(), ids):
                if at != lane:
                    lane, memory = at, OrderedDict()
                new.append(id_ not in memory)
                if new[-1]:
                    memory[id_] = None
                    if len(memory) > size:
                        memory.popitem(last=False)
            yield batch.select(names).filter(pa.array(new, pa.bool_()))

    return unknown
