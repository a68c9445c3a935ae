"""The trie of conversation prefixes, with totals of every subtree.

Conversations that open alike are computed once up to where they part. Every distinct sequence
of first turns is a node; its key is a hash of its turns with their places, combined by XOR, so
that the keys along a conversation are running combinations and a turn's removal gives the parent.

Totals go up by time-forward processing: nodes come in reverse level order from Spark's
external sort, and each sends its totals to its parent through a priority queue that spills,
which hands them out when the parent's turn comes. That runs in shards, parts of the trie with
bounded work, then across the shards' roots, and a second time in the shards that others hang
from, with what came from below.

A shard never crosses a multiple of ``depth_block`` turns, and within such a block a subtree
that weighs at most ``shard_rows`` turns is one shard. What is heavier is cut: its heavy nodes
stay with the block's root. So neither a long conversation nor an opening that a third of all
share makes a large shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import WORD, stored
from gaugeline.llm.spill_queue import HELD, SpillQueue

GROUP = 20
SHARED = 4
DEPTH_BLOCK = 64
SHARD_ROWS = 1 << 16
ID_CHUNK = 4096
NOTHING = hashlib.sha256(b"").hexdigest()

NODE = ["depth", "k1", "k2"]
PARENT = ["above", "p1", "p2"]
SHARD = ["shard_depth", "s1", "s2"]
TOTALS = ["n_children", "n_leaves", "saved_tokens"]


class Trie(NamedTuple):
    """``nodes``: depth, k1, k2 (the key), conv_id (smallest member), parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. ``members``: conv_id, depth, k1, k2, a row
    per conversation and prefix, the root included."""

    nodes: DataFrame
    members: DataFrame


def shared_turns(conv_id: Column, shared: int = SHARED) -> Column:
    """How many turns a conversation takes from the first of its group: less than ``shared``."""
    return F.crc32(conv_id.cast("string").cast("binary")) % shared


def _salts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _every(salts: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt")


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest of role and text, words. Texts go no further."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def _rebuilt(turns: DataFrame, group: int, shared: int) -> DataFrame:
    """conv_id, size, depth, digest, words: the turns of rebuilt conversations, and a root each.

    Turns are put in order by range, so a conversation with a third of all rows is cut into
    several parts; a part's place is the sum of those before it.
    """
    ranged = turns.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(
        "conv_id", F.col("turn").asc_nulls_first(), "digest", "tie"
    )
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()).drop("tie"), "turns")
    parts = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))

    first_of_group = F.col("conv_id") - F.col("conv_id") % group
    sizes = stored(parts.groupBy("conv_id").agg(F.sum("n").alias("own")), "sizes")
    wanted = sizes.withColumn("base", first_of_group).withColumn("wanted", shared_turns(F.col("conv_id"), shared))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    facts = wanted.join(bases, "base", "left").select(
        "conv_id",
        "base",
        "wanted",
        F.least("wanted", F.coalesce("there", F.lit(0))).alias("taken"),
        F.greatest(F.col("own") - F.col("wanted"), F.lit(0)).alias("left"),
    )
    facts = stored(facts.withColumn("size", F.col("taken") + F.col("left")), "facts")

    # A conversation meets what holds for it by its parts, so a long one is not one task's join.
    there = parts.select("conv_id", "part", "before").join(facts, "conv_id")
    within = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "digest")
    placed = ranged.withColumn("within", F.row_number().over(within)).join(there, ["conv_id", "part"])
    placed = placed.withColumn("place", F.col("before") + F.col("within"))
    heads = placed.where((F.col("place") < shared) & (F.col("conv_id") == F.col("base")))
    columns = ["conv_id", "size", "depth", "digest", "words"]
    own = placed.where(F.col("place") > F.col("wanted"))
    own = own.withColumn("depth", F.col("place") - F.col("wanted") + F.col("taken")).select(columns)
    # Less than ``shared`` turns of each first conversation, for the conversations of its group.
    heads = heads.select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "digest", "words")
    opened = facts.join(heads, "base").where(F.col("depth") <= F.col("taken")).select(columns)
    roots = facts.select(
        "conv_id", "size", F.lit(0).cast("long").alias("depth"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("words")
    )
    return own.unionByName(opened).unionByName(roots)


def _keyed(rebuilt: DataFrame, depth_block: int) -> DataFrame:
    """Add k1, k2 (the node), p1, p2 (its parent) and block; no window holds more than a block."""
    turn = F.col("depth") > 0
    marked = rebuilt.select(
        "conv_id",
        "size",
        "depth",
        "words",
        F.expr(f"depth div {depth_block}").alias("block"),
        F.when(turn, F.xxhash64("depth", "digest")).otherwise(F.lit(0)).cast("long").alias("z1"),
        F.when(turn, F.xxhash64("digest", "depth", F.lit(1))).otherwise(F.lit(0)).cast("long").alias("z2"),
    )
    marked = stored(marked, "rebuilt")
    ahead = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = marked.groupBy("conv_id", "block").agg(F.bit_xor("z1").alias("b1"), F.bit_xor("z2").alias("b2"))
    before = blocks.select(
        "conv_id",
        "block",
        F.coalesce(F.bit_xor("b1").over(ahead), F.lit(0)).alias("b1"),
        F.coalesce(F.bit_xor("b2").over(ahead), F.lit(0)).alias("b2"),
    )
    upto = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = marked.withColumn("r1", F.bit_xor("z1").over(upto)).withColumn("r2", F.bit_xor("z2").over(upto))
    joined = run.join(before, ["conv_id", "block"])
    for i in "12":
        joined = joined.withColumn(f"k{i}", F.col(f"r{i}").bitwiseXOR(F.col(f"b{i}")))
        joined = joined.withColumn(f"p{i}", F.col(f"k{i}").bitwiseXOR(F.col(f"z{i}")))
    return joined.select("conv_id", "size", "depth", "words", "block", "k1", "k2", "p1", "p2")


def _sharded(rows: DataFrame, depth_block: int, shard_rows: int) -> DataFrame:
    """Add the key of the shard each row's node belongs to, which is that of the shard's root.

    Few nodes are heavy: one of them has more than ``shard_rows / depth_block`` members. Many rows
    may be theirs, so rows meet them in as many parts as there are shuffle partitions.
    """
    last = (F.col("block") + 1) * depth_block - 1
    weight = F.least(F.col("size"), last) - F.col("depth") + 1
    weighed = rows.groupBy(*NODE).agg(F.sum(weight).alias("weight"))
    heavy = stored(weighed.where(F.col("weight") > shard_rows).select(*NODE), "heavy")
    salts = _salts(rows)
    salted = heavy.select("*", _every(salts), F.lit(True).alias("heavy"))
    own = F.pmod(F.xxhash64("conv_id"), F.lit(salts))
    marked = rows.withColumn("salt", own).join(salted, [*NODE, "salt"], "left").drop("salt")
    path = Window.partitionBy("conv_id", "block")
    light = F.col("heavy").isNull()
    top = F.col("block") * depth_block
    cut = F.min(F.when(light, F.col("depth"))).over(path)
    found = marked.withColumn("shard_depth", F.when(light, cut).otherwise(top)).withColumn("cut", cut)
    for i in "12":
        at_cut = F.max(F.when(F.col("depth") == F.col("cut"), F.col(f"k{i}"))).over(path)
        at_top = F.max(F.when(F.col("depth") == top, F.col(f"k{i}"))).over(path)
        found = found.withColumn(f"s{i}", F.when(light, at_cut).otherwise(at_top))
    return found.drop("heavy", "cut", "block")


def _nodes(rows: DataFrame) -> DataFrame:
    """A row per node, with what it contributes itself. Partial sums first: the root has a row per conversation."""
    same = [F.min(c).alias(c) for c in ["p1", "p2", *SHARD]]
    ends = F.count_if(F.col("depth") == F.col("size"))
    grouped = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), ends.alias("ends"), *same
    )
    return grouped.select(
        *NODE,
        F.when(F.col("depth") > 0, F.col("depth") - 1).alias("above"),
        "p1",
        "p2",
        *SHARD,
        "conv_id",
        "n_convs",
        F.lit(0).cast("long").alias("n_children"),
        (F.col("ends") == F.col("n_convs")).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )


def _send_up(held: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Add to every row's totals those of the rows below it. Rows come deepest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillQueue(6, held)
        for batch in batches:
            column = {name: batch.column(name).to_pylist() for name in [*NODE, *PARENT, *TOTALS]}
            children, leaves, saved = (column[name] for name in TOTALS)
            for i, (depth, k1, k2) in enumerate(zip(*(column[name] for name in NODE))):
                place = (-depth, k1, k2)
                while (first := queue.peek()) is not None and first[:3] == place:
                    queue.pop()
                    children[i] += 1
                    leaves[i] += first[3]
                    saved[i] += first[4]
                if column["above"][i] is not None:
                    parent = (-column["above"][i], column["p1"][i], column["p2"][i])
                    queue.push((*parent, leaves[i], saved[i], 0))
            for name, values in zip(TOTALS, (children, leaves, saved)):
                at = batch.schema.get_field_index(name)
                batch = batch.set_column(at, name, pa.array(values, pa.int64()))
            yield batch

    return run


def _forward(rows: DataFrame, held: int, shards: Sequence[str] = ()) -> DataFrame:
    """Totals within each shard, or across all rows if none are named.

    ``above`` is null in rows that send nothing. Nodes of many shards share a task, in one order.
    """
    dealt = rows.repartition(*shards) if shards else rows.repartition(1)
    in_order = dealt.sortWithinPartitions(F.col("depth").desc(), "k1", "k2")
    return in_order.mapInArrow(_send_up(held), rows.schema)


def _from_parent(rows: DataFrame, parents: DataFrame, values: Sequence[str], wide: int) -> DataFrame:
    """Inner join of rows with their parents by PARENT = NODE; ``parents`` has a row per node.

    Parents of more than ``wide`` rows, of which there are few, are met in as many parts as there
    are shuffle partitions.
    """
    salts = _salts(rows)
    counts = rows.where(F.col("above").isNotNull()).groupBy(*PARENT).agg(F.count("*").alias("n"))
    many = stored(counts.where(F.col("n") > wide).drop("n"), "wide")
    renamed = parents.select(*[F.col(a).alias(b) for a, b in zip(NODE, PARENT)], *values)
    salted = many.select("*", _every(salts)).withColumn("many", F.lit(True))
    own = F.pmod(F.xxhash64("k1", "k2"), F.lit(salts))
    split = stored(rows.withColumn("salt", own).join(salted, [*PARENT, "salt"], "left"), "split")
    spread = renamed.join(many, PARENT).select("*", _every(salts))
    common = split.where(F.col("many").isNull()).drop("salt", "many").join(renamed, PARENT)
    crowded = split.where("many").drop("many").join(spread, [*PARENT, "salt"]).drop("salt")
    return common.unionByName(crowded)


def _totalled(nodes: DataFrame, held: int, wide: int) -> DataFrame:
    """Nodes with the totals of their whole subtrees."""
    is_root = (F.col("depth") == F.col("shard_depth")) & (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2"))
    silent = nodes.withColumn("above", F.when(~is_root, F.col("above")))
    inside = stored(_forward(silent, held, SHARD), "inside")
    sending = is_root & (F.col("depth") > 0)
    tops = inside.where(is_root).withColumn("above", F.when(F.col("depth") > 0, F.col("depth") - 1))

    # Where shards hang, and so which shards others hang from.
    hooks = tops.where(sending).groupBy(*PARENT).agg(F.lit(1).alias("one"))
    places = [F.col(a).alias(b) for a, b in zip(NODE, PARENT)]
    hooks = stored(inside.select(*places, *SHARD).join(hooks, PARENT).drop("one"), "hooks")
    inner = stored(hooks.select(*SHARD).distinct(), "inner")
    as_node = inner.select(*[F.col(a).alias(b) for a, b in zip(SHARD, NODE)])
    sums = [F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")]
    outer = tops.join(as_node, NODE, "left_anti").where(sending)
    given = stored(outer.groupBy(*PARENT).agg(F.count("*").alias("n_children"), *sums), "given")

    # Across the roots of inner shards, which first get what hangs directly below.
    of_shard = given.join(hooks, PARENT).groupBy(*SHARD).agg(*sums)
    added = of_shard.select(
        *[F.col(a).alias(b) for a, b in zip(SHARD, NODE)],
        F.col("n_leaves").alias("more_leaves"),
        F.col("saved_tokens").alias("more_saved"),
    )
    roots = tops.join(as_node, NODE).select(*NODE, *PARENT, *TOTALS).join(added, NODE, "left")
    roots = stored(
        roots.select(
            *NODE,
            *PARENT,
            "n_children",
            (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        ),
        "roots",
    )
    hooked = hooks.select(*[F.col(a).alias(b) for a, b in zip(PARENT, NODE)], *SHARD)
    below = _from_parent(roots, hooked, SHARD, wide)
    hung = [F.col(a).alias(b) for a, b in zip(SHARD, PARENT)]
    kept = ["n_children", "n_leaves", "saved_tokens"]
    linked = below.select(*NODE, *hung, *kept).unionByName(
        roots.where(F.col("above").isNull()).select(*NODE, *PARENT, *kept)
    )
    across = stored(_forward(linked, held), "across")

    # A second time through the inner shards, with what their nodes get from other shards.
    final = across.select(*NODE, "n_leaves", "saved_tokens")
    sent = roots.select(*NODE, *PARENT).where(F.col("above").isNotNull()).join(final, NODE)
    got = given.unionByName(
        sent.groupBy(*PARENT).agg(F.count("*").alias("n_children"), *sums)
    ).groupBy(*PARENT).agg(*[F.sum(c).alias(f"got_{c}") for c in TOTALS])
    got = got.select(*[F.col(a).alias(b) for a, b in zip(PARENT, NODE)], *[f"got_{c}" for c in TOTALS])
    again = silent.join(inner, SHARD, "left_semi").join(got, NODE, "left")
    for c in TOTALS:
        again = again.withColumn(c, F.col(c) + F.coalesce(f"got_{c}", F.lit(0)))
    again = _forward(again.select(*silent.columns), held, SHARD)
    return inside.join(inner, SHARD, "left_anti").unionByName(again)


def _end_hashes(rows: DataFrame) -> DataFrame:
    """The sha256 over the ids of the conversations that end at a node.

    Ids come in order in chunks of bounded length, and one hash runs over a node's chunks as they
    stream by: a digest is sequential by its definition, but nothing of it is held.
    """
    ends = rows.where(F.col("depth") == F.col("size"))
    chunk = F.expr(f"conv_id div {ID_CHUNK}").alias("chunk")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    pieces = ends.groupBy(*NODE, chunk).agg(F.array_join(ids, ",").alias("ids"))
    in_order = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for *at, ids in zip(*(batch.column(c).to_pylist() for c in [*NODE, "ids"])):
                if at != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield table(done)
        if node is not None:
            yield table([(*node, state.hexdigest())])

    def table(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [[]] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=[*NODE, "ends_sha256"]
        )

    return in_order.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(
    conversations: DataFrame,
    group: int = GROUP,
    shared: int = SHARED,
    depth_block: int = DEPTH_BLOCK,
    shard_rows: int = SHARD_ROWS,
    held: int = HELD,
) -> Trie:
    """The prefix trie of the conversations, rebuilt with the opening of their group's first.

    Conversation c opens with the first :func:`shared_turns` turns of conversation c - c % ``group``
    (all it has, if fewer; none, if there is no such conversation) and goes on with its own turns
    after as many. Turns are in order of ``turn``, null first, equal numbers in order of the sha256 of
    "length of role:role text". A null role or text is empty, so equal rows are turns each.
    Rows without a ``conv_id`` belong to no conversation. A rebuilt conversation without turns is a member of the
    root alone. No conversations, no nodes, not even a root. Extra columns are dropped.

    ``held`` bounds the entries each queue keeps in memory. Nodes are told apart by 128 bits of hash.
    """
    rows = stored(_keyed(_rebuilt(_turns(conversations), group, shared), depth_block), "prefixes")
    sharded = stored(_sharded(rows, depth_block, shard_rows), "sharded")
    nodes = stored(_nodes(sharded), "nodes")
    totals = stored(_totalled(nodes, held, shard_rows), "totals")
    parents = nodes.select(*NODE, F.col("conv_id").alias("parent_conv_id"))
    below = nodes.select(*NODE, *PARENT)
    named = _from_parent(below, parents, ["parent_conv_id"], shard_rows).select(*NODE, "parent_conv_id")
    whole = totals.select(*NODE, "conv_id", "n_convs", *TOTALS).join(named, NODE, "left")
    hashed = whole.join(_end_hashes(sharded), NODE, "left")
    ends = F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")
    columns = [*NODE, "conv_id", "parent_conv_id", "n_convs", *TOTALS, ends]
    return Trie(hashed.select(columns), rows.select("conv_id", *NODE))
