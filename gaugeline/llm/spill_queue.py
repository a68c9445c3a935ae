"""A priority queue that keeps a bounded number of entries in memory and the rest in sorted runs."""

from __future__ import annotations

import heapq
import os
import struct
import tempfile
from collections.abc import Iterator
from typing import IO

Entry = tuple[int, ...]

HELD = 200_000
RUNS = 32
READ_AT_ONCE = 4096


class SpillQueue:
    """Entries are tuples of ``width`` 64-bit numbers, taken smallest first.

    Runs are nameless files in the scratch folder Spark gives the task, as its own sorts use it.
    They are gone with the task; a task run again elsewhere starts from its input.
    """

    def __init__(self, width: int, held: int = HELD, runs: int = RUNS):
        self.record = struct.Struct(f"<{width}q")
        self.held, self.most_runs = held, runs
        self.heap: list[Entry] = []
        self.heads: list[tuple[Entry, int, Iterator[Entry]]] = []  # next of each run
        self.spilled = 0

    def push(self, entry: Entry) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.held:
            self._spill()

    def peek(self) -> Entry | None:
        own = self.heap[0] if self.heap else None
        run = self.heads[0][0] if self.heads else None
        if own is None or run is None:
            return run if own is None else own
        return min(own, run)

    def pop(self) -> Entry:
        if not self.heads or (self.heap and self.heap[0] <= self.heads[0][0]):
            return heapq.heappop(self.heap)
        entry, number, rest = self.heads[0]
        following = next(rest, None)
        if following is None:
            heapq.heappop(self.heads)
        else:
            heapq.heapreplace(self.heads, (following, number, rest))
        return entry

    def _spill(self) -> None:
        if len(self.heads) >= self.most_runs:
            runs = [iter_from(head, rest) for head, _, rest in self.heads]
            self.heads = []
            self._write(heapq.merge(*runs))
        self.heap.sort()
        self._write(iter(self.heap))
        self.heap = []

    def _write(self, entries: Iterator[Entry]) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        run = tempfile.TemporaryFile(dir=folder)
        for entry in entries:
            run.write(self.record.pack(*entry))
        run.seek(0)
        reader = self._read(run)
        self.spilled += 1
        heapq.heappush(self.heads, (next(reader), self.spilled, reader))

    def _read(self, run: IO[bytes]) -> Iterator[Entry]:
        with run:
            while part := run.read(self.record.size * READ_AT_ONCE):
                yield from self.record.iter_unpack(part)


def iter_from(first: Entry, rest: Iterator[Entry]) -> Iterator[Entry]:
    yield first
    yield from rest
