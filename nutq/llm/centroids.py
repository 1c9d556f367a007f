"""Centroid clustering whose nearest centroids are found by equal-average equal-variance search.

Centroids are sorted by the mean of their components.  A vector starts at the
centroid whose mean is nearest to its own and scans outward.  With n components,
means m and deviations v (the root of the summed squared differences from the
mean), a squared distance is at least ``n (m_x - m_c)^2 + (v_x - v_c)^2``: the
first term alone ends the scan, both together skip a centroid.  What is left is
measured in integers.  Only the centroids (k times the dimension) and what
tasks have summed of their vectors travel; the vectors stay where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel

SCALE = 1024
#: Components below this are summed and squared in 64-bit integers (2 ** 10 components at most), larger ones in Python's.
_SMALL = 1 << 26
#: Sums travel as limbs of so many bits, so that partial sums of any number of tasks fit a long.
_LIMB = 40
_LIMBS = 6
#: Bounds are computed in floating point; a centroid goes only where they exceed the best distance by this share.
_SLACK = 1e-9


@dataclass
class Search:
    """Centroids in the order of their means, as tasks use them."""

    centroids: np.ndarray  # k x n, int64 or Python integers, by number
    order: np.ndarray  # numbers by ascending mean
    mean: np.ndarray
    deviation: np.ndarray

    @classmethod
    def over(cls, centroids: list[list[int]]) -> Search:
        small = all(abs(x) < _SMALL for c in centroids for x in c)
        exact = np.array(centroids, np.int64 if small else object)
        mean, deviation = _moments(exact)
        order = np.argsort(mean, kind="stable")
        return cls(exact, order, mean[order], deviation[order])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each vector's nearest centroid, ties to the smaller number."""
        n, k = len(x), len(self.order)
        mean, deviation = _moments(x)
        best = np.full(n, -1)
        found = np.zeros(n, x.dtype)
        bound = np.full(n, np.inf)  # the best distance so far, a little more than it is
        right = np.searchsorted(self.mean, mean)
        left = right - 1
        active = np.arange(n)
        while len(active):
            # The nearer of the two neighbours comes next.
            to_left = np.where(left[active] >= 0, mean[active] - self.mean[np.maximum(left[active], 0)], np.inf)
            to_right = np.where(right[active] < k, self.mean[np.minimum(right[active], k - 1)] - mean[active], np.inf)
            go = to_left <= to_right
            gap = np.where(go, to_left, to_right)
            by_mean = x.shape[1] * gap * gap * (1 - _SLACK)
            on = by_mean <= bound[active]  # beyond it every further mean is further away
            active, go, by_mean = active[on], go[on], by_mean[on]
            place = np.where(go, left[active], right[active])
            left[active] -= go
            right[active] += ~go
            spread = (deviation[active] - self.deviation[place]) ** 2 * (1 - _SLACK)
            near = by_mean + spread <= bound[active]
            rows, number = active[near], self.order[place[near]]
            difference = x[rows] - self.centroids[number]
            distance = (difference * difference).sum(axis=1)
            better = (best[rows] < 0) | (distance < found[rows]) | ((distance == found[rows]) & (number < best[rows]))
            rows = rows[better]
            best[rows], found[rows] = number[better], distance[better]
            bound[rows] = found[rows].astype(np.float64) * (1 + _SLACK)
            active = active[(left[active] >= 0) | (right[active] < k)]
        return best, found


def _moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = x.astype(np.float64)
    mean = x.mean(axis=1)
    return mean, np.sqrt(((x - mean[:, None]) ** 2).sum(axis=1))


def _limbs(value: int) -> list[int]:
    """A whole number as signed limbs, lowest first."""
    sign, rest = (-1, -value) if value < 0 else (1, value)
    return [sign * (rest >> _LIMB * i & (1 << _LIMB) - 1) for i in range(_LIMBS)]


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of whole numbers, as int64 where all are small."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if not len(flat) or np.abs(flat).max() < _SMALL:
        return flat.astype(np.int64).reshape(len(column), -1)
    return np.array([int(v) for v in flat], object).reshape(len(column), -1)


def _assigned(search: Search, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = _vectors(column)
    if x.dtype != search.centroids.dtype:  # one of both is large
        x = x.astype(object)
    cluster, distance = search.nearest(x)
    return x, cluster, distance


def _sums(search: Search):
    """What a task adds up: cluster, place (component, -1 for the distance, -2 for the number of vectors), limb, sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, n = search.centroids.shape
        total = np.zeros((k, n + 2), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, cluster, distance = _assigned(search, batch.column("v"))
            for c in np.unique(cluster):
                mine = cluster == c
                total[c, :n] += np.array([int(s) for s in x[mine].sum(axis=0)], object)
                total[c, n] += sum(map(int, distance[mine]))
                total[c, n + 1] += int(mine.sum())
        out = [(c, p if p < n else n - 1 - p, i, limb) for c in range(k) for p in range(n + 2) for i, limb in enumerate(_limbs(int(total[c, p]))) if limb]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in zip(*out, strict=True)], names=["cluster", "place", "limb", "value"])

    return run


def _members(search: Search):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, cluster, distance = _assigned(search, batch.column("v"))
                cols = [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array([_long(int(d)) for d in distance], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "cluster", "distance"])

    return run


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None


def _totals(table: DataFrame, search: Search) -> dict[tuple[int, int], int]:
    """Sums by cluster and place, a few thousand numbers whatever the table."""
    summed = table.select("v").mapInArrow(_sums(search), "cluster long, place long, limb long, value long").groupBy("cluster", "place", "limb").agg(F.sum("value").alias("value"))
    out: dict[tuple[int, int], int] = {}
    for r in summed.collect():  # at most k * (dimension + 2) * limbs rows
        out[r.cluster, r.place] = out.get((r.cluster, r.place), 0) + (r.value << _LIMB * r.limb)
    return out


def whole_vectors(vectors: DataFrame, dim: int, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and v: the vectors of ``dim`` finite components, each as floor(SCALE x), a whole double."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(embedding, lambda x: x.cast("double") * SCALE)
    whole = F.transform(scaled, lambda y: F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y))  # larger ones are whole
    return vectors.where(F.col(embedding).isNotNull() & (F.size(embedding) == dim) & fine).select(F.col(key).cast("long").alias("vec_id"), whole.alias("v"))


def cluster(spark: SparkSession, vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, seed: int = 3, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: k means of whole vectors, exactly.

    Centroids start as the k vectors with the smallest sha256 of
    ``<seed>:<id>`` (ties: the smaller vector).  Each round assigns every vector
    to its nearest centroid and moves every centroid with vectors to the floor
    of their means; then vectors are assigned once more.

    Vectors that are null, of another dimension, or hold a null or non-finite
    component take no part; repeated rows and rows without id (whose id counts
    as empty text in the hash) are vectors of their own; other columns are not
    read; with fewer than k vectors there are fewer centroids; an empty table
    gives no rows.  Components of any size are exact; a distance or sum
    beyond a long is null.
    """
    if dim > 1 << 10:
        raise ValueError("at most 1,024 components")
    table = kernel.write_table(spark, whole_vectors(vectors, dim, key, embedding))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = table.orderBy(name, "v").limit(k).collect()
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], schema)
    centroids = [[int(x) for x in r.v] for r in first]
    for _ in range(rounds):
        total = _totals(table, Search.over(centroids))
        for c in range(len(centroids)):
            if count := total.get((c, -2)):
                centroids[c] = [total.get((c, p), 0) // count for p in range(dim)]
    search = Search.over(centroids)
    total = _totals(table, search)
    inertia = [total.get((c, -1), 0) for c in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    # One entry for each of the k centroids.
    by_cluster = lambda values, kind: F.array(*[F.lit(v).cast(kind) for v in values])[F.col("cluster")]
    return table.mapInArrow(_members(search), "vec_id long, cluster int, distance long").select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster(map(_long, inertia), "long").alias("cluster_inertia"),
        F.lit(_long(sum(inertia))).cast("long").alias("inertia"),
        by_cluster(digest, "string").alias("centroid_sha256"),
    )
