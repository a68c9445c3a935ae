"""Centroid clustering in whole numbers, by equal-average equal-variance nearest neighbour search.

Vectors become whole numbers, so every sum, distance and mean is exact and no order of
adding up can change a result. The nearest centroid is searched for, not scanned for: centroids
lie sorted by the mean of their components, and from a vector's own mean the search goes
outward, nearer mean first. With d components, S for their sum and V for the root of their
squared deviations from the mean,

    d * distance² >= (S - S')²                     (equal average)
    d * distance² >= (S - S')² + d * (V - V')²     (equal variance)

The first ends the search, as means further out only differ more; the second passes over one
centroid. Both reject only what is certainly farther, so ties are settled by number.

Tasks add up their own vectors per centroid. What reaches the driver is a row per centroid
and component, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import stored

CENTROIDS = 16
ROUNDS = 3
COMPONENTS = 64
SCALE = 64
SEED = 1

# Whole components are below 2**24 in size, or squares of sums would pass 64 bits.
LARGEST = 1 << 24
MOST_COMPONENTS = 64
FAR = np.int64(1 << 62)
# Square roots and differences in double precision are off by less than this share.
SLACK = 2.0**-48


class Clustering(NamedTuple):
    """``assigned``: vec_id, cluster, distance (squared), examined (centroids whose distance was
    computed). ``centroids``: the final ones by number."""

    assigned: DataFrame
    centroids: list[tuple[int, ...]]


class MeanSearch:
    """Nearest of some centroids, for many vectors at once."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.sums, self.vectors = sums[self.number], centroids[self.number]
        self.spreads = self._spread(self.vectors, self.sums)

    @staticmethod
    def _spread(vectors: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """The root of d * V², which is a whole number under the root."""
        squares = np.einsum("ij,ij->i", vectors, vectors)
        return np.sqrt((vectors.shape[1] * squares - sums * sums).astype(np.float64))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """number, squared distance and distances computed, for each row of ``vectors``."""
        n, size = vectors.shape
        last = len(self.sums) - 1
        own = vectors.sum(axis=1)
        spread = self._spread(vectors, own)
        right = np.searchsorted(self.sums, own)
        left = right - 1
        best = np.full(n, FAR // size, dtype=np.int64)
        number = np.full(n, last + 1, dtype=np.int64)
        examined = np.zeros(n, dtype=np.int32)
        live = np.arange(n)
        while len(live):
            l, r, mine = left[live], right[live], own[live]
            down = np.where(l >= 0, mine - self.sums[np.maximum(l, 0)], FAR)
            up = np.where(r <= last, self.sums[np.minimum(r, last)] - mine, FAR)
            off, leftward = np.minimum(down, up), down <= up
            limit = best[live] * size
            within = off < FAR
            # The product is only looked at where a centroid is left.
            within[within] = off[within] * off[within] <= limit[within]
            live, leftward, off, limit = live[within], leftward[within], off[within], limit[within]
            at = np.where(leftward, left[live], right[live])
            left[live[leftward]] -= 1
            right[live[~leftward]] += 1
            a, b = spread[live], self.spreads[at]
            apart = np.maximum(np.abs(a - b) - (a + b) * SLACK, 0.0)
            open_ = apart * apart * (1 - SLACK) <= (limit - off * off).astype(np.float64) * (1 + SLACK)
            rows, at = live[open_], at[open_]
            difference = vectors[rows] - self.vectors[at]
            distance = np.einsum("ij,ij->i", difference, difference)
            examined[rows] += 1
            found = self.number[at]
            nearer = (distance < best[rows]) | ((distance == best[rows]) & (found < number[rows]))
            best[rows[nearer]], number[rows[nearer]] = distance[nearer], found[nearer]
        return number, best, examined


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, size)


def whole_vectors(
    vectors: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """vec_id and ``whole``: floor(scale * x) of every component of the vectors that count.

    Those have exactly ``components`` components, none null or non-finite. A component whose
    whole number is not below 2**24 in size is refused with an error, as distances to it would not be
    exact in 64 bits.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = rows.where((F.size("x") == components) & finite)
    too_large = F.raise_error(F.lit(f"a component times {scale} is not below {LARGEST} in size"))
    whole = F.transform(
        "x", lambda x: F.when(F.abs(x * scale) < LARGEST, F.floor(x * scale)).otherwise(too_large.cast("bigint"))
    )
    return kept.select("vec_id", whole.alias("whole"))


def _start(whole: DataFrame, centroids: int, seed: int) -> np.ndarray:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = whole.orderBy(F.sha2(name, 256), "whole").limit(centroids).collect()
    return np.array([r["whole"] for r in first], dtype=np.int64)


def _totals(whole: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """How many vectors each centroid is nearest to, and their sum by component."""
    size = centroids.shape[1]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = MeanSearch(centroids)
        sums, rows = np.zeros_like(centroids), np.zeros(len(centroids), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column(0), size)
                number, _, _ = search.nearest(vectors)
                order = np.argsort(number, kind="stable")
                found, first = np.unique(number[order], return_index=True)
                sums[found] += np.add.reduceat(vectors[order], first, axis=0)
                rows += np.bincount(number, minlength=len(rows))
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": pa.array(some, pa.int32()),
                "n": pa.array(rows[some], pa.int64()),
                "sums": pa.array(list(sums[some]), pa.list_(pa.int64())),
            }
        )

    parts = whole.select("whole").mapInArrow(add_up, "cluster int, n long, sums array<long>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
    added = each.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("part").alias("part"))
    found: dict[int, tuple[int, list[int]]] = {}
    for r in added.orderBy("cluster", "at").collect():  # a row per centroid and component
        found.setdefault(r["cluster"], (r["n"], []))[1].append(r["part"])
    return found


def _assigned(whole: DataFrame, centroids: np.ndarray) -> DataFrame:
    size = centroids.shape[1]
    vec_id = whole.schema["vec_id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = MeanSearch(centroids)
        for batch in batches:
            number, distance, examined = search.nearest(_matrix(batch.column(1), size))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance), pa.array(examined)],
                names=["vec_id", "cluster", "distance", "examined"],
            )

    return whole.select("vec_id", "whole").mapInArrow(
        assign, f"vec_id {vec_id}, cluster int, distance long, examined int"
    )


def cluster(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: int = SEED,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> Clustering:
    """Cluster all vectors in ``rounds`` rounds and assign them once more.

    Centroids start as the vectors whose ``seed:vec_id`` has the smallest sha256, smallest
    first; at equal ids the smaller vector is first. A round replaces each centroid by the
    floor of the mean of its vectors; one without vectors stays. Vectors equally near to several
    centroids go to the one with the smallest number.

    Vectors that :func:`whole_vectors` leaves out take no part. Rows without an id are vectors
    whose id is empty text; repeated rows are vectors each. Fewer vectors than centroids
    make as many centroids as there are vectors, and an empty table an empty result. Extra
    columns are dropped.
    """
    if components > MOST_COMPONENTS:
        raise ValueError(f"more than {MOST_COMPONENTS} components are not exact in 64 bits")
    whole = stored(whole_vectors(vectors, components, scale, vec_id, embedding), "whole")
    at = _start(whole, centroids, seed)
    if not len(at):
        empty = whole.select(
            "vec_id", *[F.lit(0).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("examined", "int"))]
        )
        return Clustering(empty.limit(0), [])
    for _ in range(rounds):
        at = at.copy()
        for number, (rows, sums) in _totals(whole, at).items():
            at[number] = [total // rows for total in sums]
    return Clustering(stored(_assigned(whole, at), "assigned"), [tuple(map(int, c)) for c in at])


def digest(found: Clustering) -> DataFrame:
    """vec_id, cluster, distance, inertia of its cluster and of all, and a hash of its centroid."""
    spark = found.assigned.sparkSession
    each = found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    sums = {r["cluster"]: int(r["sum"]) for r in each.collect()}  # a row per centroid
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    total = sum(sums.values())
    rows = [(c, n, total, names[c]) for c, n in sums.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid.
    joined = found.assigned.drop("examined").join(F.broadcast(facts), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
