"""Chat formatting by the cheapest role repair, then rendering.

A legal conversation is an optional system message and then user and assistant messages in
turn, from the user. Each turn of a conversation takes one of a few steps: its message
keeps its role or is relabelled, and it starts a message, joins the one before, or starts
one after an empty message has been put in. Every step has a cost; the states of the automaton
are the roles of the last message, so the cheapest repair is a shortest path over turns.

Costs of a run of turns are a matrix over states, and matrices of neighbouring runs multiply
(in minimum and sum). So a conversation is cut into blocks: each block's matrix is computed
by itself, only the matrices of one conversation meet in a row, and each block then finds its
own path between the states at its ends. No task holds more than a block's turns, or as
many small matrices as a conversation has blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import stored

START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = {code: name for name, code in ROLES.items()}
# Other names for the roles.
ALIASES = {
    "human": "user", "prompter": "user", "customer": "user",
    "bot": "assistant", "ai": "assistant", "gpt": "assistant", "model": "assistant",
    "developer": "system",
}

# Legal successors of the last message's role.
AFTER = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}

BLOCK = 512
OPENING = 256  # characters of a role or text that decide an order of ties before its hash does


class Costs(NamedTuple):
    relabel: float = 1.0
    merge: float = 0.4
    insert: float = 0.7
    unknown: float = 0.1  # giving a role to a message that has none


class Step(NamedTuple):
    """From one state to another: the role taken, whether it merges, the role put in before."""

    source: int
    target: int
    merge: bool
    inserted: int
    cost: tuple[float, float, float, float]  # by the message's own role; place 0: none


def _steps(costs: Costs) -> list[Step]:
    """All steps, in the order that settles ties: fewer changes first."""

    def price(role: int, extra: float) -> tuple[float, ...]:
        own = (costs.unknown, *(0.0 if r == role else costs.relabel for r in (SYSTEM, USER, ASSISTANT)))
        return tuple(extra + c for c in own)

    plain = [Step(s, t, False, 0, price(t, 0.0)) for s in AFTER for t in AFTER[s]]
    merged = [Step(s, s, True, 0, price(s, costs.merge)) for s in (SYSTEM, USER, ASSISTANT)]
    filled = [
        Step(s, t, False, put, price(t, costs.insert))
        for s in AFTER
        for put in AFTER[s]
        for t in AFTER[put]
        if put != SYSTEM
    ]
    return plain + merged + filled


STATES = 4
FAR = 1e18
ANY_END = -1


class Moves(NamedTuple):
    """By a message's own role, from state to state: the least cost, and the step that has it."""

    cost: np.ndarray
    step: list[list[list[Step | None]]]


def _moves(costs: Costs) -> Moves:
    least = np.full((STATES, STATES, STATES), FAR)
    best: list = [[[None] * STATES for _ in range(STATES)] for _ in range(STATES)]
    for step in _steps(costs):
        for role, cost in enumerate(step.cost):
            if cost < least[role, step.source, step.target]:
                least[role, step.source, step.target] = cost
                best[role][step.source][step.target] = step
    return Moves(least, best)


def block_matrix(roles: np.ndarray, moves: Moves) -> np.ndarray:
    """The least cost from each state before a block of turns to each state after it."""
    total = np.full((STATES, STATES), FAR)
    np.fill_diagonal(total, 0.0)
    for role in roles:
        total = (total[:, :, None] + moves.cost[role][None]).min(axis=1)
    return np.minimum(total, FAR)


def block_path(roles: np.ndarray, moves: Moves, start: int, end: int) -> list[Step]:
    """The cheapest steps of a block between two states, or to any."""
    ahead = np.full((len(roles) + 1, STATES), FAR)
    ahead[-1, slice(None) if end == ANY_END else end] = 0.0
    for i in range(len(roles) - 1, -1, -1):
        ahead[i] = (moves.cost[roles[i]] + ahead[i + 1]).min(axis=1)
    path, state = [], start
    for i, role in enumerate(roles):
        target = int(np.argmin(moves.cost[role, state] + ahead[i + 1]))
        path.append(moves.step[role][state][target])
        state = target
    return path


def _numbered(turns: DataFrame, block: int) -> DataFrame:
    """Add ``place``, from 0 within the conversation, and its block.

    Equal turns are one row with a count until they have places. Rows are dealt by ranges of the order and
    numbered within; the sizes of the ranges of a conversation are added up. So neither a long conversation nor
    one turn number that many rows have is one window.
    """
    by_conv = "conv_id"
    once = turns.groupBy(by_conv, "turn", "role", "text").agg(F.count("*").alias("_copies"))
    # Keys of ranges are sampled on the driver, so they are short; the hash tells long texts apart.
    order = {
        "_turn": F.col("turn"),
        "_role": F.substring("role", 1, OPENING),
        "_text": F.substring("text", 1, OPENING),
        "_hash": F.xxhash64("role", "text"),
    }
    keyed = once.withColumns(order).repartitionByRange(by_conv, *order)
    dealt = stored(keyed.withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy(by_conv, "_part").agg(F.sum("_copies").alias("_n"))
    earlier = Window.partitionBy(by_conv).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        F.col(by_conv).alias("_conv"),
        F.col("_part").alias("_of"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    ahead = Window.partitionBy(by_conv, "_part").orderBy(*order, "role", "text")
    ahead = ahead.rowsBetween(Window.unboundedPreceding, -1)
    same = F.col(by_conv).eqNullSafe(F.col("_conv")) & (F.col("_part") == F.col("_of"))
    within = F.coalesce(F.sum("_copies").over(ahead), F.lit(0))
    first = dealt.withColumn("_within", within).join(before, same).withColumn("_first", F.col("_before") + F.col("_within"))
    places = F.sequence(F.col("_first"), F.col("_first") + F.col("_copies") - 1)
    return first.select(*turns.columns, F.explode(places).alias("place")).withColumn(
        "block", F.floor(F.col("place") / block)
    )


def escaped(text: Column) -> Column:
    """``text`` with a backslash more in each ``<|``, ``<\\|`` and so on, so that it holds no mark of a turn.

    Taking one backslash out of each gives the text back.
    """
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def _role_code(role: Column) -> Column:
    """1 to 3, by name or alias whatever the case; 0 for null and unknown names."""
    code, name = F.lit(0), F.lower(F.trim(role))
    for known, number in [*ROLES.items(), *((alias, ROLES[to]) for alias, to in ALIASES.items())]:
        code = F.when(name == known, number).otherwise(code)
    return code


def _blocks(moves: Moves):
    def matrices(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            cost = [block_matrix(np.asarray(roles), moves).ravel().tolist() for roles in part["roles"]]
            yield part.assign(cost=cost)

    return matrices


def _ends(group: pd.DataFrame) -> pd.DataFrame:
    """Through the matrices of one conversation: the states at the ends of its blocks."""
    rows = group.sort_values("block")
    costs = [np.asarray(c).reshape(STATES, STATES) for c in rows["cost"]]
    ahead = [np.zeros(STATES)]
    for cost in reversed(costs):
        ahead.append((cost + ahead[-1][None, :]).min(axis=1))
    ahead.reverse()
    state, starts, stops = START, [], []
    for i, cost in enumerate(costs):
        starts.append(state)
        state = int(np.argmin(cost[state] + ahead[i + 1]))
        stops.append(state)
    return rows.assign(start=starts, stop=stops)[["conv_key", "block", "start", "stop"]]


def _paths(moves: Moves):
    def paths(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for roles, start, stop in zip(part["roles"], part["start"], part["stop"]):
                codes = np.asarray(roles)
                path = block_path(codes, moves, int(start), int(stop))
                rows.append(
                    [(s.target, int(s.merge), s.inserted, s.cost[r]) for s, r in zip(path, codes)]
                )
            yield pd.DataFrame(
                {"conv_key": part["conv_key"], "block": part["block"]}
                | {
                    name: [[x[k] for x in row] for row in rows]
                    for k, name in enumerate(("taken", "merged", "put", "cost"))
                }
            )

    return paths


def repair(conversations: DataFrame, costs: Costs = Costs(), block: int = BLOCK) -> DataFrame:
    """Every turn with its repaired role and its rendered piece.

    Returns conv_id, turn, place, role, new_role, action (keep, relabel, merge, or merge+relabel),
    inserted (role of an empty message put in before, or null), cost, piece. Joined in the
    order of ``place``, the pieces of a conversation are its rendering.

    Turns go by number, null first, ties by the first 256 characters of role and of text, then by a
    hash of both; repeated rows are turns of their own. What looks like a mark in a text is escaped.
    A null or unknown role takes the cheapest role; a null text is empty. A null conv_id is
    a conversation. A system message that cannot stand first is relabelled. An empty
    table gives an empty result; extra columns are dropped.
    """
    moves = _moves(costs)
    turns = conversations.select(
        F.col("conv_id").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.col("role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    placed = stored(
        _numbered(turns, block).withColumn("conv_key", key).withColumn("code", _role_code(F.col("role"))), "turns"
    )
    # A block is at most ``block`` small numbers.
    listed = F.sort_array(F.collect_list(F.struct("place", "code")))
    blocks = stored(
        placed.groupBy("conv_key", "block").agg(F.transform(listed, lambda x: x["code"]).alias("roles")), "blocks"
    )
    sizes = placed.groupBy("conv_key").agg(F.max("place").alias("last"))
    spread = stored(blocks.join(sizes, "conv_key"), "spread")
    # Only conversations of several blocks have ends that must meet.
    long = spread.where(F.col("last") >= block)
    matrices = long.select("conv_key", "block", "roles").mapInPandas(
        _blocks(moves), "conv_key string, block long, roles array<int>, cost array<double>"
    )
    shape = "conv_key string, block long, start int, stop int"
    ends = matrices.drop("roles").groupBy("conv_key").applyInPandas(_ends, shape)
    short = spread.where(F.col("last") < block).select(
        "conv_key", "block", "roles", F.lit(START).alias("start"), F.lit(ANY_END).alias("stop")
    )
    bounded = long.join(ends, ["conv_key", "block"]).select(short.columns).union(short)
    shape = (
        "conv_key string, block long, taken array<int>, merged array<int>, put array<int>, "
        "cost array<double>"
    )
    paths = bounded.mapInPandas(_paths(moves), shape)
    at = (F.col("place") % block).cast("int")
    found = placed.join(paths, ["conv_key", "block"]).select(
        "conv_id", "turn", "place", "role", "text", "code", "conv_key", "block",
        *[F.get(c, at).alias(c) for c in ("taken", "merged", "put", "cost")],
    )
    relabelled = F.col("code") != F.col("taken")
    merges = F.col("merged") == 1
    action = (
        F.when(merges & relabelled, "merge+relabel")
        .when(merges, "merge")
        .when(relabelled, "relabel")
        .otherwise("keep")
    )
    name = lambda code: F.get(F.array(F.lit(None).cast("string"), *[F.lit(NAMES[i]) for i in (1, 2, 3)]), code)
    opening = lambda role: F.concat(F.lit("<|"), role, F.lit("|>\n"))
    close = F.lit("<|end|>\n")
    # Each piece closes the message before it, so only a conversation's first turn does not.
    before = F.when(merges, "\n\n").otherwise(
        F.concat(
            F.when(F.col("place") > 0, close).otherwise(""),
            F.coalesce(F.concat(opening(name(F.col("put"))), close), F.lit("")),
            opening(name(F.col("taken"))),
        )
    )
    whole = found.join(spread.select("conv_key", "block", "last"), ["conv_key", "block"])
    after = F.when(F.col("place") == F.col("last"), close).otherwise("")
    return whole.select(
        "conv_id",
        "turn",
        "place",
        "role",
        name(F.col("taken")).alias("new_role"),
        action.alias("action"),
        name(F.col("put")).alias("inserted"),
        F.round("cost", 6).alias("cost"),
        F.concat(before, escaped(F.col("text")), after).alias("piece"),
    )


def render(repaired: DataFrame) -> DataFrame:
    """conv_id and rendered, one row per conversation; each must fit into a row."""
    pieces = F.sort_array(F.collect_list(F.struct("place", "piece")))
    joined = F.array_join(F.transform(pieces, lambda x: x["piece"]), "")
    return repaired.groupBy("conv_id").agg(joined.alias("rendered"))
