"""Best-fit packing of tokenized documents into sequences of fixed capacity.

Lengths are whole numbers up to the capacity, so the bins can be planned from the number of
pieces per length alone: at most ``capacity`` counts reach the driver, however large the
corpus. The plan says how many bins hold which lengths; the n-th piece of a length then
finds its bin by its running number, in parallel.

* Pieces above one third of the capacity fit at most twice into a bin. The longest left is
  matched with the longest that still fits beside it, or stays alone.
* Smaller pieces, longest first, go into the bin with the smallest gap that holds them, and
  open a new bin only when no gap does.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import stored
from gaugeline.llm.tokens import token_ids

CAPACITY = 2048
END_OF_DOCUMENT = 0
ID_BYTES = 4
WINDOW = 1 << 16  # documents
WINDOW_SHIFT = 32  # bits of a sequence's number within its window


class Slots(NamedTuple):
    """``each * bins`` pieces of one length: ``each`` of them in a row, in every bin of a run."""

    length: int
    first_rank: int
    each: int
    bins: int
    first_bin: int
    offset: int


class _Plan:
    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.bins = capacity, 0
        self.left = {size: n for size, n in counts.items() if n}
        self.used: dict[int, int] = defaultdict(int)
        self.slots: list[Slots] = []
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first bin, bins)
        self.gaps: list[int] = []  # ascending

    def open(self, bins: int) -> int:
        first, self.bins = self.bins, self.bins + bins
        return first

    def fill(self, length: int, each: int, bins: int, first_bin: int, offset: int) -> None:
        self.slots.append(Slots(length, self.used[length], each, bins, first_bin, offset))
        self.used[length] += each * bins
        self.left[length] -= each * bins

    def leave(self, gap: int, first_bin: int, bins: int) -> None:
        if gap and bins:
            if not self.runs[gap]:
                insort(self.gaps, gap)
            self.runs[gap].append((first_bin, bins))

    def tightest(self, length: int) -> tuple[int, int, int]:
        """Take out the run of bins with the smallest gap of at least ``length``."""
        place = bisect_left(self.gaps, length)
        if place == len(self.gaps):
            needed = -(-self.left[length] // (self.capacity // length))
            return self.capacity, self.open(needed), needed
        gap = self.gaps[place]
        first, bins = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.gaps[place]
        return gap, first, bins

    def match_large(self, lengths: list[int]) -> None:
        waiting = sorted(lengths)
        while waiting:
            longest = waiting[-1]
            place = bisect_right(waiting, self.capacity - longest) - 1
            partner = waiting[place] if place >= 0 else None
            if partner == longest and self.left[longest] < 2:
                partner = waiting[place - 1] if place >= 1 else None
            if partner is None:
                pairs = self.left[longest]
            elif partner == longest:
                pairs = self.left[longest] // 2
            else:
                pairs = min(self.left[longest], self.left[partner])
            first = self.open(pairs)
            self.fill(longest, 1, pairs, first, 0)
            if partner is not None:
                self.fill(partner, 1, pairs, first, longest)
            self.leave(self.capacity - longest - (partner or 0), first, pairs)
            waiting = [x for x in waiting if self.left[x]]

    def fit_small(self, lengths: list[int]) -> None:
        for length in sorted(lengths, reverse=True):
            while self.left[length]:
                gap, first, bins = self.tightest(length)
                # Best fit puts the next equal piece into the same bin while it holds one.
                each = gap // length
                full = min(bins, self.left[length] // each)
                offset = self.capacity - gap
                if full:
                    self.fill(length, each, full, first, offset)
                    self.leave(gap - each * length, first, full)
                rest = self.left[length] if full < bins else 0
                if rest:
                    self.fill(length, rest, 1, first + full, offset)
                    self.leave(gap - rest * length, first + full, 1)
                self.leave(gap, first + full + bool(rest), bins - full - bool(rest))


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Where the pieces of each length go. ``counts``: pieces per length, 1 to ``capacity``.

    The number of slots depends on the capacity, not on the counts: a length either uses up a
    run of equal bins, more than halving its gap, or is itself used up.
    """
    plan = _Plan(counts, capacity)
    large = [size for size in plan.left if 3 * size > capacity]
    small = [size for size in plan.left if 3 * size <= capacity]
    plan.match_large(large)
    plan.fit_small(small)
    return plan.slots


def cut(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_OF_DOCUMENT,
    token_text: str = "text",
    keep: Sequence[Column] = (),
) -> DataFrame:
    """Tokenize whole texts and cut those above ``capacity``: doc_id, ``keep``, piece, start, length, ids.

    ``ids`` holds little-endian unsigned 32-bit token ids. Every document ends with
    ``end_id``, so a null or empty text is one piece of one id. Other columns are dropped.
    """
    size = capacity * ID_BYTES
    end = F.lit(int(end_id).to_bytes(ID_BYTES, "little"))
    whole = docs.select(
        F.col("doc_id").alias("doc_id"),
        *keep,
        F.concat(token_ids(tokenizer)(F.coalesce(token_text, F.lit(""))), end).alias("whole"),
    )
    kept = [c for c in whole.columns if c != "whole"]
    numbered = whole.select(
        *kept,
        F.explode(F.expr(f"sequence(0, cast((length(whole) - 1) div {size} as int))")).alias("piece"),
        "whole",
    )
    ids = F.expr(f"substring(whole, piece * {size} + 1, {size})")
    return numbered.select(
        *kept,
        "piece",
        (F.col("piece").cast("long") * capacity).alias("start"),
        (F.length(ids) / ID_BYTES).cast("long").alias("length"),
        ids.alias("ids"),
    )


def _numbered(pieces: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0.

    Half of all pieces can have one length. They are numbered in parts dealt by hash, and
    only the sizes of the parts are added up.
    """
    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [c for c in pieces.columns if c != "length"]
    dealt = pieces.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    sizes = dealt.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    ahead = F.sum("_n").over(
        Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = sizes.select("length", "_part", F.coalesce(ahead, F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_part").orderBy(*order))
    placed = dealt.withColumn("_within", within).join(before, ["length", "_part"])
    rank = F.col("_before") + F.col("_within") - 1
    return placed.withColumn("_rank", rank).drop("_part", "_within", "_before")


SHIFT = 1 << 44  # ranks of one length; with lengths below a million the key fits 64 bits


def _slot_table(slots: list[Slots]) -> np.ndarray:
    return np.array(sorted(slots), dtype=np.int64).reshape(-1, len(Slots._fields))


def _places(table: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset there of the piece with each rank among those of its length."""
    starts = table[:, 0] * SHIFT + table[:, 1]
    found = table[np.searchsorted(starts, length * SHIFT + rank, side="right") - 1]
    size, first_rank, each, _, first_bin, offset = found.T
    turn = rank - first_rank
    return first_bin + turn // each, offset + turn % each * size


def _finder(slots: list[Slots]):
    table = _slot_table(slots)

    @F.pandas_udf("sequence_id long, offset long")
    def find(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for length, rank in parts:
            bins, offset = _places(table, length.to_numpy(np.int64), rank.to_numpy(np.int64))
            yield pd.DataFrame({"sequence_id": bins, "offset": offset})

    return find


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    ``pieces`` must read the same again (a stored table): it is counted first and placed
    after. Pieces in a sequence lie gapless from 0. An empty table gives an empty result;
    equal rows get places of their own; columns other than ``length`` only break ties. Their
    names may not be ``sequence_id``, ``offset`` or start with ``_``.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    found = _finder(plan_bins(counts, capacity))(F.col("length"), F.col("_rank"))
    placed = _numbered(pieces).withColumn("_place", found)
    return placed.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_OF_DOCUMENT,
    with_ids: bool = False,
) -> DataFrame:
    """Tokenize, cut and pack ``docs`` (doc_id, text): a row per piece with its place.

    ``ids_crc32`` is the checksum of the piece's ids; ``with_ids`` keeps the ids as well, for
    :func:`sequences`. The pieces are stored once, so the texts are tokenized once. Null ids
    and repeated rows are documents like any other. Extra columns are dropped.
    """
    pieces = cut(docs, tokenizer, capacity, end_id).withColumn("ids_crc32", F.crc32("ids"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return pack(stored(pieces.select(columns), "pieces"), capacity)


def pack_in_order(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_OF_DOCUMENT,
    documents: int = WINDOW,
) -> DataFrame:
    """As :func:`pack_documents`, for documents that lie in training order in the files they are read from.

    Documents that follow each other, ``documents`` at most and never beyond a split of a file, are a
    window. Each window is packed by itself, in parallel and in bounded memory, and sequences are
    numbered window after window, so training by ``sequence_id`` keeps the order up to a
    window. Adds ``window``. A window's last sequences are all that this costs. Files are
    taken in the order of their names; rows that come from no file in that of their partitions.
    """
    at = F.struct(
        F.input_file_name().alias("file"),
        F.input_file_block_start().alias("block"),
        F.expr(f"monotonically_increasing_id() div {documents}").alias("part"),
    )
    pieces = cut(docs, tokenizer, capacity, end_id, keep=[at.alias("at")])
    columns = ["doc_id", "piece", "start", "length"]
    pieces = stored(pieces.select("at", *columns, F.crc32("ids").alias("ids_crc32")), "pieces")
    # A row per window.
    number = F.row_number().over(Window.orderBy("at")) - 1
    windows = pieces.select("at").distinct().withColumn("window", number.cast("long"))
    numbered = pieces.join(windows, "at").drop("at")
    doc_id = numbered.schema["doc_id"].dataType
    # Ids go through Python as text, where a null makes no number inexact.
    texts = numbered.withColumn("doc_id", F.col("doc_id").cast("string"))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start"], kind="stable", na_position="first")
        length = rows["length"].to_numpy(np.int64)
        sizes, counts = np.unique(length, return_counts=True)
        table = _slot_table(plan_bins(dict(zip(sizes.tolist(), counts.tolist())), capacity))
        bins, offset = _places(table, length, rows.groupby("length").cumcount().to_numpy(np.int64))
        first = rows["window"].iloc[0] << WINDOW_SHIFT
        return rows.assign(sequence_id=first + bins, offset=offset)

    schema = T.StructType([*texts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    placed = texts.groupBy("window").applyInPandas(place, schema)
    return placed.select(
        F.col("doc_id").cast(doc_id).alias("doc_id"), *columns[1:], "ids_crc32", "sequence_id", "offset", "window"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, doc_ids, ids (little-endian, 4 bytes each).

    A group is one sequence, so it never holds more than the capacity.
    """
    rows = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    grouped = packed.groupBy("sequence_id").agg(rows.alias("rows"))
    joined = F.aggregate("rows", F.lit(b""), lambda acc, row: F.concat(acc, row["ids"]))
    return grouped.select("sequence_id", F.col("rows.doc_id").alias("doc_ids"), joined.alias("ids"))
