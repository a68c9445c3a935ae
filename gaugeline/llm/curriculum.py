"""Mix sources to target weights along a curriculum.

Every source gets a target of words, a share of the mix by weight, never above a number of
passes over the source; what a full source cannot take is shared again among the others. A
source's weight may change during training: the integral of its schedule is the share of
its target demanded up to each moment, and inverting that integral gives every document it
contributes a position in training, between 0 and 1. The mix is the documents in the order
of their positions.

Documents of a source come in the order of the md5 of their id. No step holds a source, or
any other group that grows with the corpus, in one task: words are added up per source and
per slice of the order, and only the slices' sums are put in a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import WORD, stored, text_key

# A schedule: (moment, weight) from moment 0 to 1, straight between them, never negative.
Schedule = Sequence[tuple[float, float]]

SHARE = 1.5
PASSES = 2
WEIGHTS = (3, 1, 2)
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 1.0), (1.0, 1.0)),
)

SLICE_DIGITS = 3  # hexadecimal digits of the order's md5 that make a slice


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, source, size in words (null text: 0)."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    key = text_key(F.col("text")).alias("text_key")
    return docs.select("doc_id", key, "source", words.cast("long").alias("size"))


def targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
) -> DataFrame:
    """source, turn, source_size, target: one row per source.

    ``weights`` go round the sources in code point order, null last. A source is full when
    ``passes`` times its size is below its share. Sources sorted by that ratio of room to
    weight fill one after the other, so the level of the rest follows from running sums over
    the sources alone; ``share`` must not exceed ``passes``.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("turn") + 1)
    room = F.col("source_size") * F.lit(float(passes))
    rows = each.withColumn("turn", turn).withColumn("weight", weight).withColumn("room", room)
    fill = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ahead = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    left = F.greatest(total - F.coalesce(F.sum("room").over(ahead), F.lit(0.0)), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(onward))
    # Up to the first source whose share fits, all are full; from there on the level stays.
    fits = F.when(F.col("level") * F.col("weight") <= F.col("room"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(
        fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    target = F.least(F.coalesce(level * F.col("weight"), F.col("room")), F.col("room"))
    return rows.select("source", "turn", "source_size", target.alias("target"))


def _ordered(rows: DataFrame) -> DataFrame:
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    slice_of = F.substring("_order", 1, SLICE_DIGITS)
    return rows.withColumn("_order", order).withColumn("_slice", slice_of)


def _slices(ordered: DataFrame) -> DataFrame:
    """Per source and slice, the words of the source in earlier slices: _name, _at, _before."""
    sums = ordered.groupBy("source", "_slice").agg(F.sum("size").alias("_words"))
    ahead = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_words").over(ahead), F.lit(0))
    return sums.select(F.col("source").alias("_name"), F.col("_slice").alias("_at"), before.alias("_before"))


def _spread(slices: DataFrame, per_source: DataFrame) -> DataFrame:
    """What holds for a source, for each of its slices; ``per_source`` names it ``_source``.

    Documents meet it by slice, so a source with a third of them is not one task's join.
    """
    same = F.col("_name").eqNullSafe(F.col("_source"))
    return slices.join(per_source, same).drop("_source")


def _with_slice(rows: DataFrame, spread: DataFrame) -> DataFrame:
    same = F.col("source").eqNullSafe(F.col("_name")) & (F.col("_slice") == F.col("_at"))
    return rows.join(spread, same).drop("_name", "_at")


def _moment(u: Column, turn: Column, schedules: Sequence[Schedule]) -> Column:
    """The moment by which the share ``u`` of a source's target is demanded."""
    found = F.lit(None).cast("double")
    for k, schedule in reversed(list(enumerate(schedules))):
        spans = [
            (t0, w0, (w1 - w0) / (t1 - t0), (w0 + w1) / 2 * (t1 - t0))
            for (t0, w0), (t1, w1) in zip(schedule, schedule[1:])
        ]
        area = sum(span[3] for span in spans)
        moment, reached = F.lit(1.0), area
        for t0, w0, slope, own in reversed(spans):
            reached -= own
            rest = F.greatest(u * F.lit(area) - F.lit(reached), F.lit(0.0))
            if slope:
                step = (F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0))) - w0) / slope
            else:
                step = rest / w0 if w0 else F.lit(0.0)
            here = F.lit(t0) + step
            moment = here if reached + own >= area else F.when(u * F.lit(area) < reached + own, here).otherwise(moment)
        found = F.when(turn % len(schedules) == k, F.least(moment, F.lit(1.0))).otherwise(found)
    return found


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = SHARE,
    passes: int = PASSES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """What the mix takes of every document, and when.

    Returns doc_id, ``keep`` (``text_key`` tells texts of one id apart), source, size, source_size, target, taken (words, repeats counted), copies
    and positions (one moment per copy), sorted by the first position; documents not taken
    come last.

    Documents are taken whole. A source runs through its full passes, then takes documents
    in order while they fit what is left of its target; last comes the one document, among those not taken in
    this pass, whose size brings the sum nearest to the target, if any brings it nearer. Documents without
    words are in no pass. Null ids and texts, a null source and repeated rows are
    documents and a source like any other; extra columns are dropped; an empty table, or one
    without words, takes nothing.
    """
    rows = stored(sized(docs), "sizes")
    quotient = F.floor(F.col("target") / F.col("source_size"))
    full = F.when(F.col("source_size") > 0, quotient).otherwise(0).cast("long")
    shares = (
        targets(rows, weights, share, passes)
        .withColumnRenamed("source", "_source")
        .withColumn("_full", full)
        .withColumn("_rest", F.col("target") - F.col("_full") * F.col("source_size"))
    )
    ordered = _ordered(rows)
    slices = stored(_spread(_slices(ordered), shares), "slices")
    within = (
        Window.partitionBy("source", "_slice")
        .orderBy("_order", "doc_id", "size", "text_key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.col("_before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    some = F.col("size") > 0
    fits = some & (F.col("start") + F.col("size") <= F.col("_rest"))
    placed = _with_slice(ordered, slices).withColumn("start", start).withColumn("_fits", fits)
    placed = stored(placed.drop("_order", "_before"), "order")

    got = F.coalesce(F.sum(F.when(F.col("_fits"), F.col("size"))), F.lit(0))
    filled = placed.groupBy("source").agg(F.max("_rest").alias("_left"), got.alias("_got"))
    filled = filled.select(
        F.col("source").alias("_source"), "_got", (F.col("_left") - F.col("_got")).alias("_gap")
    )
    keys = slices.select("_name", "_at")
    off = F.abs(F.col("size") - F.col("_gap"))
    nearest = F.min(F.struct(off.alias("off"), "start", "size"))
    closing = (
        _with_slice(placed.where(some & ~F.col("_fits")), _spread(keys, filled))
        .where(off < F.col("_gap"))
        .groupBy(F.col("source").alias("_closed"))
        .agg(nearest.alias("_last"))
    )
    ends = filled.join(closing, F.col("_source").eqNullSafe(F.col("_closed")), "left").drop("_closed")
    # Among documents with words, a start belongs to one row of the source.
    closes = some & F.coalesce(F.col("start") == F.col("_last.start"), F.lit(False))
    before = F.col("_full") * F.col("source_size")
    everything = before + F.col("_got") + F.coalesce(F.col("_last.size"), F.lit(0))
    runs = F.transform(
        F.sequence(F.lit(0), F.lit(passes - 1)),
        lambda k: F.when(some & (k < F.col("_full")), k * F.col("source_size") + F.col("start")),
    )
    extra = F.when(F.col("_fits"), before + F.col("start")).when(closes, before + F.col("_got"))
    starts = F.filter(F.concat(runs, F.array(extra)), lambda at: at.isNotNull())
    joined = _with_slice(placed, _spread(keys, ends))
    joined = joined.withColumn("_starts", starts).withColumn("_all", everything)
    middle = F.col("size") / 2
    moments = F.transform(
        "_starts", lambda at: _moment((at + middle) / F.col("_all"), F.col("turn"), schedules)
    )
    copies = F.size("_starts").cast("long")
    return joined.select(
        "doc_id",
        *keep,
        "source",
        "size",
        "source_size",
        "target",
        (copies * F.col("size")).alias("taken"),
        copies.alias("copies"),
        moments.alias("positions"),
    ).orderBy(F.get("positions", 0).asc_nulls_last(), "doc_id")
