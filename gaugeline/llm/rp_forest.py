"""Nearest neighbours by cosine: a forest of random-projection trees, searched through one queue.

Every tree halves space again and again by a random direction at the median, fitted on a
bounded sample; every vector is then put into one leaf of each tree. A query goes down all
trees at once: one queue holds the branches not taken, nearest dividing plane first, and leaves
are opened in that order until they hold a share of the index. The candidates in those
leaves are scored exactly.

How large a share is needed is a property of the vectors, not of their number: among
directions without structure near and far differ little, and no tree can skip much.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import let, stored

TREES = 12
DEPTH = 7
SAMPLE = 16384
SHARE = 0.9  # of the index's size, in candidates counted once per tree
LEAST = 64  # candidates per tree, so that a small index is searched whole
BLOCK = 4096
NEAR = 1e-9  # scores of one product of matrices are off by less


class Forest(NamedTuple):
    """Complete trees as arrays by tree and node; the children of node n are 2n + 1 and 2n + 2."""

    depth: int
    planes: np.ndarray
    cuts: np.ndarray

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree, numbered from 0."""
        out = np.empty((len(vectors), len(self.planes)), dtype=np.int64)
        for t, (planes, cuts) in enumerate(zip(self.planes, self.cuts)):
            node = np.zeros(len(vectors), dtype=np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", vectors, planes[node]) > cuts[node]
                node = 2 * node + 1 + side
            out[:, t] = node - len(planes)
        return out

    def open_leaves(self, vector: np.ndarray, sizes: np.ndarray, enough: float) -> list[tuple[int, int]]:
        """Trees and leaves in the order of the shared queue, until they hold ``enough``."""
        inner = self.planes.shape[1]
        margins = self.planes @ vector - self.cuts
        queue = [(0.0, t, 0) for t in range(len(self.planes))]
        found, held = [], 0
        while queue and held < enough:
            far, t, node = heapq.heappop(queue)
            while node < inner:
                margin = margins[t, node]
                right = bool(margin > 0)
                heapq.heappush(queue, (max(far, abs(margin)), t, 2 * node + 2 - right))
                node = 2 * node + 1 + right
            if sizes[t, node - inner]:
                found.append((t, node - inner))
                held += int(sizes[t, node - inner])
        return found


def grow(sample: np.ndarray, trees: int, depth: int, seed: int = 0) -> Forest:
    """Trees over unit vectors. A node's direction is the difference of two of its sample's
    vectors, or random where it has fewer; its cut is the sample's median."""
    rng = np.random.default_rng(seed)
    inner, size = (1 << depth) - 1, sample.shape[1]
    planes, cuts = np.zeros((trees, inner, size)), np.zeros((trees, inner))
    for t in range(trees):
        parts = {0: np.arange(len(sample))}
        for node in range(inner):
            rows = parts.pop(node)
            plane = rng.normal(size=size)
            if len(rows) > 1:
                a, b = sample[rng.choice(rows, 2, replace=False)]
                plane = a - b if np.any(a != b) else plane
            plane /= np.linalg.norm(plane)
            at = sample[rows] @ plane
            cut = float(np.median(at)) if len(rows) else 0.0
            planes[t, node], cuts[t, node] = plane, cut
            parts[2 * node + 1], parts[2 * node + 2] = rows[at <= cut], rows[at > cut]
    return Forest(depth, planes, cuts)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _scaled(vector: Column) -> Column:
    """The vector times a power of two that brings its largest component near 1.

    Neither cosines nor their rounding change by it, and no product is too small or large.
    """

    def by(v: Column) -> Column:
        power = -F.floor(F.log2(F.array_max(F.transform(v, F.abs))))
        half = F.floor(power / 2)
        return F.transform(v, lambda x: x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half))

    return let(vector, by)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def classes(vectors: DataFrame, keep: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Distinct usable vectors: class_id, ids, vector; ``ids`` are the ``keep`` smallest of them.

    Vectors that are a power of two times each other are one class, as their cosines are the same.

    Null, empty and zero vectors, vectors with a null or non-finite component or of another length than most,
    and rows without id take no part. A third of all rows can be one vector: only the
    smallest ids of each task reach the group.
    """
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector")
    )
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(~bad & some)
    by_length = usable.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows"))
    length = by_length.orderBy(F.desc("rows"), F.desc("n")).first()
    usable = usable.where(F.size("vector") == (length["n"] if length else 0))
    usable = usable.withColumn("vector", _scaled(F.col("vector"))).distinct()
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    firsts = usable.withColumn("place", place).where(F.col("place") <= keep)
    grouped = firsts.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return grouped.select(F.get("ids", 0).alias("class_id"), "ids", "vector")


def _leaf_of(forest: Forest):
    @F.pandas_udf("array<long>")
    def leaf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            found = forest.leaves(_unit(_matrix(part))) if len(part) else np.zeros((0, 0))
            yield pd.Series([row.tolist() for row in found])

    return leaf


def _leaves_for(forest: Forest, sizes: np.ndarray, enough: float):
    leaves = 1 << forest.depth

    @F.pandas_udf("array<long>")
    def opened(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            units = _unit(_matrix(part)) if len(part) else []
            yield pd.Series(
                [[t * leaves + leaf for t, leaf in forest.open_leaves(u, sizes, enough)] for u in units]
            )

    return opened


def _in_order(products: np.ndarray) -> np.ndarray:
    """Sums of rows, component after component."""
    total = np.zeros(len(products))
    for column in products.T:
        total += column
    return total


def _best(keep: int):
    """The best of a block of a leaf for each of a block of queries, by exact score, then number.

    A product of matrices finds who can be among them; whoever is as near as the last, up to what
    rounding may hide, is scored again component after component, however many they are.
    """

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query": [], "class_id": [], "score": []}).astype(
                {"query": "int64", "class_id": "int64", "score": "float64"}
            )
        asked, there = _matrix(left["vector"]), _matrix(right["vector"])
        near = _unit(asked) @ _unit(there).T
        ids, n = right["class_id"].to_numpy(np.int64), min(keep, near.shape[1])
        least = -np.partition(-near, n - 1, axis=1)[:, n - 1]
        row, column = np.nonzero(near >= (least - NEAR)[:, None])
        a, b = np.sqrt(_in_order(asked * asked)), np.sqrt(_in_order(there * there))
        score = _in_order(asked[row] * there[column]) / (a[row] * b[column])
        order = np.lexsort((ids[column], -score, row))
        row, column, score = row[order], column[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        first = place < n
        return pd.DataFrame(
            {"query": left["query"].to_numpy(np.int64)[row[first]], "class_id": ids[column[first]], "score": score[first]}
        )

    return best


def _blocks(counts: DataFrame, block: int) -> DataFrame:
    return counts.select("leaf", F.ceil(F.col("n") / block).cast("long").alias("blocks"))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    trees: int = TREES,
    depth: int = DEPTH,
    sample: int = SAMPLE,
    share: float = SHARE,
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` nearest found of every query, its own row excepted: query_id, rank, vec_id, score.

    ``is_query`` is a condition on ``vec_id``. Equal vectors are one class to the search; ties go
    to the smaller id. Fewer candidates than ``k`` are all returned; an empty table gives an
    empty result. Rows that repeat an id and a vector are one. Extra columns are dropped.
    ``sample`` bounds the vectors the trees are fitted on; all are indexed.
    """
    wanted = k + 1  # a query's own id is among its nearest and goes at the end
    known = stored(classes(vectors, wanted), "classes")
    total = known.count()
    picked = known.orderBy(F.xxhash64("class_id"), "class_id").limit(sample)
    rows = picked.select("vector").collect()
    shape = len(rows[0]["vector"]) if rows else 1
    fitted = np.array([r["vector"] for r in rows], dtype=float).reshape(len(rows), shape)
    forest = grow(_unit(fitted), trees, depth)
    leaves = 1 << depth

    spots = F.posexplode(_leaf_of(forest)("vector")).alias("tree", "spot")
    leaf = (F.col("tree") * leaves + F.col("spot")).alias("leaf")
    index = stored(known.select("class_id", "vector", spots).select("class_id", "vector", leaf), "index")
    counts = index.groupBy("leaf").agg(F.count("*").alias("n"))
    sizes = np.zeros((trees, leaves), dtype=np.int64)
    for r in counts.collect():  # one row per leaf
        sizes[r["leaf"] // leaves, r["leaf"] % leaves] = r["n"]

    # Every query's row, and each distinct vector among them searched once.
    own = F.col("vec_id").cast("long").alias("query_id")
    asking = vectors.where(is_query & F.col("vec_id").isNotNull()).select(
        own, F.col("embedding").cast("array<double>").alias("vector")
    )
    usable = F.exists("vector", lambda x: x != 0) & ~F.exists("vector", lambda x: x.isNull())
    asking = asking.where(usable).withColumn("vector", _scaled(F.col("vector"))).distinct()
    asking = stored(asking.join(known.select("class_id", "vector"), "vector"), "asking")
    asked = asking.groupBy(F.col("class_id").alias("query")).agg(F.first("vector").alias("vector"))
    enough = max(share * total, max(LEAST, wanted) * trees)
    opened = F.explode(_leaves_for(forest, sizes, enough)("vector")).alias("leaf")
    probes = stored(asked.select("query", "vector", opened), "probes")

    # A leaf and the queries that open it are met block by block, whatever their numbers.
    asks = _blocks(probes.groupBy("leaf").agg(F.count("*").alias("n")), block)
    holds = _blocks(counts, block)
    grid = asks.withColumnRenamed("blocks", "q").join(holds.withColumnRenamed("blocks", "h"), "leaf")
    all_h = F.explode(F.sequence(F.lit(0).cast("long"), F.col("h") - 1)).alias("i")
    all_q = F.explode(F.sequence(F.lit(0).cast("long"), F.col("q") - 1)).alias("j")
    left = probes.join(grid, "leaf").select(
        "leaf", all_h, F.pmod(F.xxhash64("query"), F.col("q")).alias("j"), "query", "vector"
    )
    right = index.join(grid, "leaf").select(
        "leaf", F.pmod(F.xxhash64("class_id"), F.col("h")).alias("i"), all_q, "class_id", "vector"
    )
    near = (
        left.groupBy("leaf", "i", "j")
        .cogroup(right.groupBy("leaf", "i", "j"))
        .applyInPandas(_best(wanted), "query long, class_id long, score double")
    )
    # A class found in several trees has the same score in each.
    once = near.groupBy("query", "class_id").agg(F.first("score").alias("score"))
    first = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "class_id"))
    short = once.withColumn("n", first).where(F.col("n") <= wanted).drop("n")

    scored = short.join(known.select("class_id", "ids"), "class_id").select(
        "query", F.explode("ids").alias("vec_id"), "score"
    )
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = scored.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= wanted)
    answers = F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("answers")
    lists = listed.groupBy("query").agg(answers)
    others = F.slice(F.filter("answers", lambda a: a["vec_id"] != F.col("query_id")), 1, k)
    told = asking.join(lists, F.col("class_id") == F.col("query")).select(
        "query_id", F.posexplode(others).alias("rank", "answer")
    )
    return told.select("query_id", (F.col("rank") + 1).alias("rank"), "answer.vec_id", "answer.score")
