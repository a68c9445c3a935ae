"""The first arrival of every id on a stream, remembered in the state store.

The rule is that of :func:`gaugeline.operators.ranking.dedup_within`, told by arrival times alone.
State holds the kept arrivals of ids, many numbers of a station in one row, so a station that
counts up touches few rows. A batch reads and writes the rows of its own ids; what others
amount to does not matter.

An arrival is forgotten when both clocks say so: two horizons have passed since it was processed, and
the watermark over arrival times, two horizons behind the latest and never ahead of the
present, is past it. A stream that was stopped for long still knows what its backlog needs, and on a live
one a single clock ahead makes no id forgotten. Nothing waits for the watermark, and nothing is
dropped for being late.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gaugeline.schemas import ARRIVAL_ORDER

NUMBERS_PER_ROW = 64
# Groups over which messages that could not be read are dealt; they have no id, and nothing is kept for them.
UNREAD_GROUPS = 64
# By this a stateful operator knows the column of the watermark.
WATERMARK_KEY = "spark.watermarkDelayMs"
STATE = "numbers array<long>, moments array<long>, processed array<long>"

Entry = tuple[int, int, int]  # number, second of arrival, millisecond of processing


def _entries(state: GroupState) -> list[Entry]:
    return list(zip(*state.get)) if state.exists else []


def _keep_in_mind(state: GroupState, entries: list[Entry], horizon: int, now: int) -> None:
    """Store what is not forgotten and ask again when the watermark gets there, or remove the row."""
    passed, wait = state.getCurrentWatermarkMs(), 2 * horizon * 1000
    known = [e for e in entries if now - e[2] < wait or e[1] * 1000 >= passed]
    if known:
        state.update(tuple(list(column) for column in zip(*known)))
        state.setTimeoutTimestamp(max(max(e[1] for e in known) * 1000, passed + horizon * 1000) + 1)
    elif state.exists:
        state.remove()


def _accepter(horizon: int, names: list[str]):
    def accept(key: Any, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            _keep_in_mind(state, _entries(state), horizon, state.getCurrentProcessingTimeMs())
            return
        if key[0] is None or key[0] != key[0]:  # messages that could not be read
            for part in parts:
                yield part[names]
            return
        # The first copy of every id and second; later chunks of a busy one add little.
        firsts: dict[tuple[int, int | None], tuple[tuple[int, int], pd.DataFrame, int]] = {}
        for part in parts:
            rows = zip(part["s_no"].tolist(), part["_second"].tolist(), part["partition"].tolist(), part["offset"].tolist())
            for i, (number, second, partition, offset) in enumerate(rows):
                at = (int(number), int(second) if second is not None and second == second else None)
                found = firsts.get(at)
                if found is None or (partition, offset) < found[0]:
                    firsts[at] = ((partition, offset), part, i)
        entries = _entries(state)
        moments: dict[int, list[int]] = {}
        for number, moment, _ in entries:
            insort(moments.setdefault(number, []), moment)
        now = state.getCurrentProcessingTimeMs()
        kept: dict[int, tuple[pd.DataFrame, list[int]]] = {}
        for number, second in sorted(firsts, key=lambda at: (at[0], at[1] is not None, at[1] or 0)):
            _, part, i = firsts[number, second]
            if second is not None:
                known = moments.setdefault(number, [])
                place = bisect_right(known, second)
                if place and second - known[place - 1] < horizon:
                    continue
                known.insert(place, second)
                entries.append((number, second, now))
            kept.setdefault(id(part), (part, []))[1].append(i)
        _keep_in_mind(state, entries, horizon, now)
        for part, chosen in kept.values():
            yield (part if len(chosen) == len(part) else part.iloc[sorted(chosen)])[names]

    return accept


def _without_copies(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first copy of every id and second of each chunk, before anything is shuffled."""
    for part in parts:
        read = part["valid"]
        if part.duplicated(["station_id", "s_no", "_second"])[read].any():
            ordered = part.sort_values(ARRIVAL_ORDER, kind="stable")
            copies = ordered.duplicated(["station_id", "s_no", "_second"]) & ordered["valid"]
            part = ordered[~copies]
        yield part


def first_arrivals(parsed: DataFrame, horizon: int) -> DataFrame:
    """A stream of parsed messages without repeats; those that could not be read all stay.

    Of an id, an arrival is kept if and only if no kept one lies within ``horizon`` seconds before it.
    ``value`` is null where the message was read. Arrivals without a time cannot be compared: the first of
    an id and micro-batch is kept.
    """
    columns = parsed.columns
    marked = parsed.withColumns(
        {
            "value": F.when(~F.col("valid"), F.col("value")),
            "_second": F.unix_timestamp("timestamp"),
            # Numbers go through Python unharmed, whatever the year.
            "timestamp": F.unix_micros("timestamp"),
        }
    )
    fewer = marked.mapInPandas(_without_copies, marked.schema)
    unread = F.pmod(F.xxhash64("partition", "offset", "value"), F.lit(UNREAD_GROUPS))
    block = F.when(F.col("valid"), F.expr(f"s_no div {NUMBERS_PER_ROW}")).otherwise(unread)
    delay = 2 * horizon
    now = F.current_timestamp()
    clock = F.least(F.timestamp_seconds(F.greatest(F.coalesce("_second", F.lit(0)), F.lit(0))), now)
    dealt = fewer.withColumn("_block", block)
    clocked = dealt.withColumn("_clock", clock).withWatermark("_clock", f"{delay} seconds")
    # The watermark is taken from the arrivals; the time by which a row would be called late is the present.
    present = F.greatest("_clock", now).alias("_clock", metadata={WATERMARK_KEY: delay * 1000})
    kept = clocked.select(*dealt.columns, present).groupBy("station_id", "_block").applyInPandasWithState(
        _accepter(horizon, dealt.columns), dealt.schema, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return kept.withColumn("timestamp", F.timestamp_micros("timestamp")).select(columns)
