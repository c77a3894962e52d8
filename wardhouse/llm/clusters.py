"""Centroid clustering in exact integers; the nearest centroid is found by the threshold algorithm.

For every dimension the centroids are sorted by their value. From a vector's value the lists are walked outward, one
centroid per dimension and step; each centroid met for the first time gets its exact distance. The squares of the
frontiers' distances, summed over the dimensions, bound every centroid not met: once they strictly exceed the best exact
distance the walk ends. Equal distances go to the smaller number, so equality does not end it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.llm.common import arrow_flow, cut

SCALE, ROUNDS = 1024, 10
# Pairs of vector and centroid whose distances are computed at once.
PAIRS = 1 << 14


def largest(size: int) -> int:
    """Integers up to this keep a squared distance over `size` components within a long."""
    most = 1
    while size * (4 * most) ** 2 < 2**63:
        most *= 2
    return most


def usable(vector: Column, size: int, scale: int = SCALE) -> Column:
    """Exactly `size` components, none null or non-finite, and none so large that squared distances leave the longs."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * scale) >= largest(size)))
    return F.coalesce((F.size(vector) == size) & ~bad, F.lit(False))


class Lists:
    """The centroids with one sorted list per dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable").T
        self.values = np.take_along_axis(centroids.T, self.order, 1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each vector's nearest centroid."""
        n, k = len(vectors), len(self.centroids)
        best, dist = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
        met = np.zeros((n, k), bool)
        # Next entry to the right and to the left of the vector's value, by dimension.
        right = np.stack([np.searchsorted(v, x) for v, x in zip(self.values, vectors.T)], axis=1) if n else np.zeros((0, 0), int)
        left = right - 1
        alive = np.arange(n)
        dims = np.arange(vectors.shape[1])[None, :]
        far = np.iinfo(np.int64).max
        for _ in range(k):
            if not len(alive):
                break
            x, r, below_at = vectors[alive], right[alive], left[alive]
            above = np.where(r < k, self.values[dims, np.minimum(r, k - 1)] - x, far)
            below = np.where(below_at >= 0, x - self.values[dims, np.maximum(below_at, 0)], far)
            up = above <= below
            pick = np.where(up, np.minimum(r, k - 1), np.maximum(below_at, 0))
            right[alive], left[alive] = r + up, below_at - ~up
            self._measure(vectors, alive, self.order[dims, pick], met, best, dist)
            frontier = np.where(up, above, below)
            alive = alive[(frontier * frontier).sum(axis=1) <= dist[alive]]
        return best, dist

    def _measure(self, vectors, alive, numbers, met, best, dist) -> None:
        """Exact distances of the centroids that are met for the first time."""
        now = np.zeros((len(alive), len(self.centroids)), bool)
        now[np.arange(len(alive))[:, None], numbers] = True
        row, number = np.nonzero(now & ~met[alive])
        met[alive] |= now
        for at in range(0, len(row), PAIRS):
            who, which = alive[row[at : at + PAIRS]], number[at : at + PAIRS]
            gap = vectors[who] - self.centroids[which]
            exact = np.einsum("ij,ij->i", gap, gap)
            # By vector the nearest first, then the smaller number.
            first = np.lexsort((which, exact, who))
            first = first[np.r_[True, who[first][1:] != who[first][:-1]]]
            who, which, exact = who[first], which[first], exact[first]
            better = (exact < dist[who]) | ((exact == dist[who]) & (which < best[who]))
            best[who[better]], dist[who[better]] = which[better], exact[better]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _sums(points: DataFrame, lists: Lists, size: int) -> DataFrame:
    """(cluster, dim, total, n): every task adds up its vectors first, so few rows are shuffled."""

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        k = len(lists.centroids)
        total, count = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            vectors = _matrix(batch.column("vector"), size)
            number, _ = lists.nearest(vectors)
            np.add.at(total, number, vectors)
            count += np.bincount(number, minlength=k)
        cluster, dim = np.nonzero(np.repeat(count[:, None] > 0, size, axis=1))
        yield {"cluster": pa.array(cluster), "dim": pa.array(dim), "total": pa.array(total[cluster, dim]), "n": pa.array(count[cluster])}

    parts = arrow_flow(points.select("vector"), flow, "cluster int, dim int, total long, n long")
    return parts.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def cluster(
    df: DataFrame, size: int = 64, k: int = 8, rounds: int = ROUNDS, seed: int = 3, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """One row per kept vector: its id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Components become floor(scale * x). Centroids 0, 1, ... start as the k vectors with the smallest SHA-256 of
    `<seed>:<id>`; equal ids (a null one counts as the empty text) go by vector, and fewer than k vectors give as many
    centroids. A round assigns all vectors and moves every non-empty centroid to the floor of its vectors' mean. Rounds
    end early when no centroid moved, since the rest would change nothing either. Repeated rows count as often as they
    occur; null vectors and those of another size, with null or non-finite components, or beyond `largest(size)` take no
    part; no rows give no rows. Sums beyond a long are null. Centroids (k x size numbers) are all that reaches the driver.
    """
    number = df[vector_col].cast("array<double>")
    rows = df.where(usable(df[vector_col], size, scale)).select(
        df[id_col].alias("id"), F.transform(number, lambda x: F.floor(x * scale).cast("int")).alias("vector")
    )
    points = cut(rows)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    starts = points.withColumn("name", F.sha2(name, 256)).orderBy("name", "vector").limit(k).select("vector").collect()
    if not starts:
        return _described(points.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), {}, id_col)

    centroids = np.array([r["vector"] for r in starts], np.int64)
    for _ in range(rounds):
        moved = centroids.copy()
        for r in _sums(points, Lists(centroids), size).collect():
            moved[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
        if (moved == centroids).all():
            break
        centroids = moved
    lists = Lists(centroids)

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            found, dist = lists.nearest(_matrix(batch.column("vector"), size))
            yield {"id": batch.column("id"), "cluster": pa.array(found), "distance": pa.array(dist)}

    kind = points.schema["id"].dataType.simpleString()
    assigned = cut(arrow_flow(points, flow, f"id {kind}, cluster int, distance long"))
    digests = {j: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for j, c in enumerate(centroids.tolist())}
    return _described(assigned, digests, id_col)


def _described(assigned: DataFrame, digests: dict[int, str], id_col: str) -> DataFrame:
    """With the inertias: one sum per centroid reaches the driver."""
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("part")).collect()
    as_long = lambda n: n if n < 2**63 else None
    whole = as_long(int(sum(r["part"] for r in sums)))
    rows = [(r["cluster"], as_long(int(r["part"])), whole, digests[r["cluster"]]) for r in sums]
    small = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(small), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
