import hashlib
import math
import random

import numpy as np
import pytest

from nutq.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, distance int, v string"


def plain(rows, k, rounds, dim):
    """Every distance to every centroid in Python's integers."""
    kept = [(i, [math.floor(1024 * x) for x in e]) for i, e, *_ in rows if e and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in kept[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((square(v, c), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, mine in groups.items():
            centres[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = [sum(d for _, d, j in found if j == c) for c in range(len(centres))]
    fits = lambda x: x if x < 1 << 63 else None
    return sorted(((i, j, fits(d), fits(total[j]), fits(sum(total)), hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()) for i, d, j in found), key=repr)


def vector_rows(dim, n=300, seed=1, scale=1.0):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, scale) for _ in range(dim)] for _ in range(5)]
    rows = [(i, [m + rng.gauss(0, scale / 3) for m in rng.choice(middle)]) for i in range(n)]
    rows += [rows[3], rows[3], (None, rows[4][1]), (n, rows[5][1]), (n + 1, None), (n + 2, []), (n + 3, [1.0] * (dim - 1)), (n + 4, [None] * dim), (n + 5, [float("nan")] * dim), (n + 6, [float("inf")] * dim), (n + 7, [0.0] * dim), (n + 8, [-0.0] * dim)]
    return [(*r, 1, "c", 2, "v") for r in rows]


def as_rows(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("k", "dim", "scale"), [(8, 6, 1.0), (3, 1, 0.002), (40, 4, 0.01), (8, 4, 1e12), (8, 4, 1e30), (1, 3, 5.0)])
def test_clusters_equal_all_distances(spark, k, dim, scale):
    rows = vector_rows(dim, scale=scale)
    got = as_rows(centroids.cluster(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), k=k, rounds=4, dim=dim))
    assert got == plain(rows, k, 4, dim)


def test_small_and_large_components_together(spark):
    rows = vector_rows(3, 60) + [(900, [1e25, 2.0, -3e30], 1, "c", 2, "v"), (901, [1e25, 2.0, -3e30], 1, "c", 2, "v")]
    got = as_rows(centroids.cluster(spark, spark.createDataFrame(rows, SCHEMA).repartition(4), k=4, rounds=3, dim=3))
    assert got == plain(rows, 4, 3, 3)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(5, [1.0, 2.0], 1, "c", 2, "v"), (6, [1.0, 2.0], 1, "c", 2, "v")]
    frame = lambda r: spark.createDataFrame(r, SCHEMA)
    assert as_rows(centroids.cluster(spark, frame(rows), dim=2)) == plain(rows, 8, 10, 2)
    assert centroids.cluster(spark, frame([]), dim=2).collect() == []


def test_search_skips_centroids():
    """The bounds leave out most of the exact distances."""
    rng = np.random.default_rng(2)
    middle = rng.integers(-50_000, 50_000, (200, 1)) + rng.integers(-300, 300, (200, 16)) * rng.integers(1, 20, (200, 1))
    search = centroids.Search.over(middle.tolist())
    x = middle[rng.integers(0, 200, 500)] + rng.integers(-30, 30, (500, 16))
    measured = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            measured.append(len(key))
            return super().__getitem__(key)

    search.centroids = search.centroids.view(Counted)
    best, found = search.nearest(x)
    every = ((x[:, None] - middle[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (np.asarray(found) == every.min(axis=1)).all()
    assert sum(measured) < 500 * 200 / 10
