"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits, one per majority among the hashes of a text's shingles. Cut into
segments, two fingerprints at a small distance agree in some segment or nearly do, so
looking up small Hamming balls around each segment's value finds all of them; the complete
distance then decides.

With ``m`` segments and a distance of ``r = a * m + b``, balls of radius ``a`` in the first
``b + 1`` segments and ``a - 1`` in the others are enough: beyond all of them, the distances
add up to more than ``r``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import stored
from gaugeline.llm.components import components

BITS = 64
SEED = 42
SHINGLE = 4
DISTANCE = 4
SEGMENTS = 3

# A segment value of more fingerprints than this is searched in blocks, not by a join.
CROWD = 48
BLOCK = 2048

HASHES_AT_ONCE = 1 << 16


def fingerprint_of(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed number; 0 if there is no word.

    Only A to Z are lower-cased, and words end at the blanks that end them for bytes: space
    and the codes 9 to 13. Repeated shingles count each time.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(BITS, dtype=np.int64), len(words) - width + 1
    for at in range(0, n, HASHES_AT_ONCE):
        to = min(n, at + HASHES_AT_ONCE)
        starts = [ends[at - 1] if at else 0, *ends[at : to - 1]]
        hashes = [
            digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[at + width - 1 : to + width - 1])
        ]
        raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text as a long; a null text counts as empty."""

    @F.pandas_udf("long")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([fingerprint_of(t, shingle) for t in part], dtype="int64")

    return of(F.coalesce(text, F.lit("")))


def _layout(segments: int, distance: int) -> list[tuple[int, int, int]]:
    """shift, width and radius of every segment that is searched."""
    radius, rest = divmod(distance, segments)
    widths = [BITS // segments + (i < BITS % segments) for i in range(segments)]
    shifts = [sum(widths[i + 1 :]) for i in range(segments)]
    radii = [radius if i <= rest else radius - 1 for i in range(segments)]
    return [x for x in zip(shifts, widths, radii) if x[2] >= 0]


def _values(layout: list[tuple[int, int, int]]) -> list[Column]:
    return [
        F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)) for shift, width, _ in layout
    ]


def _entries(prints: DataFrame, layout: list[tuple[int, int, int]]) -> DataFrame:
    """The tables: each fingerprint under its value in each segment."""
    rows = [F.struct(F.lit(i).alias("segment"), v.alias("value")) for i, v in enumerate(_values(layout))]
    return prints.select("fp", F.explode(F.array(*rows)).alias("at")).select("at.*", "fp")


def _probes(prints: DataFrame, layout: list[tuple[int, int, int]]) -> DataFrame:
    """The balls: every value within the radius that is not below the own one.

    Of two fingerprints with different values, the one with the smaller value finds the other.
    """

    def ball(segment: int, own: Column) -> Column:
        _, width, radius = layout[segment]
        flips = [sum(1 << b for b in c) for r in range(1, radius + 1) for c in combinations(range(width), r)]
        masks = F.array(*[F.lit(f).cast("long") for f in [0, *flips]])
        up = F.filter(F.transform(masks, lambda flip: own.bitwiseXOR(flip)), lambda value: value >= own)
        return F.transform(
            up,
            lambda value: F.struct(
                F.lit(segment).alias("segment"), value.alias("value"), (value == own).alias("exact")
            ),
        )

    balls = [ball(i, own) for i, own in enumerate(_values(layout))]
    return prints.select("fp", F.explode(F.concat(*balls)).alias("at")).select("at.*", "fp")


def _within(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def _forest(distance: int):
    """Links that tie together whatever is linked in a group, at most one per member.

    Members found from one are not compared with each other: a dense group costs a pass, only
    one without links costs all pairs, and none are written.
    """

    def tie(group: pd.DataFrame) -> pd.DataFrame:
        left = np.unique(group["fp"].to_numpy(np.int64))
        ties: list[tuple[int, int]] = []
        while len(left):
            reached, left = [left[0]], left[1:]
            while reached and len(left):
                one = reached.pop()
                near = np.bitwise_count((left ^ one).view(np.uint64)) <= distance
                if near.any():
                    found = left[near]
                    ties += [(one, other) for other in found]
                    reached += list(found)
                    left = left[~near]
        return pd.DataFrame(ties, columns=["a", "b"], dtype="int64")

    return tie


def _crowded_links(
    entries: DataFrame, probes: DataFrame, crowds: DataFrame, distance: int, block: int
) -> DataFrame:
    """Links through crowded values, in blocks: each pair of blocks is one group of bounded size."""
    there = entries.join(crowds, ["segment", "value"]).select("segment", "value", "fp")
    asking = probes.join(crowds, ["segment", "value"]).select("segment", "value", "fp")
    members = there.union(asking).distinct()
    sizes = members.groupBy("segment", "value").agg(F.ceil(F.count("*") / block).alias("blocks"))
    own = F.pmod(F.xxhash64("fp", "value"), F.col("blocks"))
    dealt = members.join(sizes, ["segment", "value"]).withColumn("own", own)
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    keyed = pairs.select(
        "segment", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"
    )
    return keyed.groupBy("segment", "value", "i", "j").applyInPandas(_forest(distance), "a long, b long")


def links(
    prints: DataFrame,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
    crowd: int = CROWD,
    block: int = BLOCK,
) -> DataFrame:
    """Links between distinct fingerprints (``prints``: fp), enough to tie all that are linked.

    A segment value that at most ``crowd`` fingerprints have is looked up by a join, which
    returns every link found there. Under a value that more have, a third of all may differ in a
    few bits, so those are searched in blocks that return a spanning forest each. ``prints``
    should be stored: it is read several times.
    """
    layout = _layout(segments, distance)
    entries, probes = _entries(prints, layout), _probes(prints, layout)
    counts = entries.groupBy("segment", "value").agg(F.count("*").alias("n"))
    crowds = stored(counts.where(F.col("n") > crowd).select("segment", "value"), "crowds")
    sparse = entries.join(crowds, ["segment", "value"], "left_anti").withColumnRenamed("fp", "b")
    asked = probes.withColumnRenamed("fp", "a")
    # Within one value both sides ask for each other; once is enough.
    once = (~F.col("exact")) | (F.col("a") < F.col("b"))
    found = asked.join(sparse, ["segment", "value"])
    near = found.where(once & _within("a", "b", distance)).select("a", "b")
    return near.union(_crowded_links(entries, probes, crowds, distance, block)).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
    crowd: int = CROWD,
    block: int = BLOCK,
) -> DataFrame:
    """doc_id, text_key, fp, root and component_id, the smallest id reachable over links.

    ``root`` is the smallest fingerprint of the component and tells components apart.
    Equal fingerprints are one node, so copies add nothing to the search. Texts without words
    all have fingerprint 0 and are linked like others. Null ids are documents; a component
    of null ids only has a null id. Repeated rows, ties and extra columns change nothing.
    ``segments`` grows the tables' values when lowered: three hold a few fingerprints a value
    up to some hundred million of them, two far beyond.
    """
    printed = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        fingerprint(F.col("text"), shingle).alias("fp"),
    )
    printed = stored(printed, "fingerprints")
    prints = stored(printed.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    tied = components(links(prints.select("fp"), distance, segments, crowd, block))
    rooted = prints.join(tied.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = rooted.join(least, "root").select("fp", "root", "component_id")
    return printed.join(of_print, "fp").select("doc_id", "text_key", "fp", "root", "component_id")
