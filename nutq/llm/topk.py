"""Exact top-k inner-product search by Fagin's threshold algorithm.

Vectors are dealt into blocks.  A block of candidates is shuffled once, and the
blocks of queries (the stated 1 of 50 rows) come to it one after another.  Its
task sorts it once for each dimension, whatever the number of queries, and every
query reads these lists in step, from the end that its component favours.  A vector
met for the first time is scored in full.  The values at the present depth
bound the score of every vector not met yet; when the bound cannot beat the
kth best score, the query is done with the block.  The best of all blocks are
merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import kernel

SCALE = 256
CANDIDATES = 4096
QUERIES = 2048
#: Candidates with a component from here on are scored in Python's integers.
_LARGE = 1 << 22
#: Depth of the first step into the lists; each next step doubles it.
STEP = 16


def threshold_search(vectors: np.ndarray, ids: np.ndarray, order: np.ndarray, query: np.ndarray, k: int, own: int = -1) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the k best rows, ties to the smaller id; ``own`` is left out.

    ``order`` has, for each dimension, the rows by ascending value.
    """
    n = len(vectors)
    scores, met = np.full(n, -np.inf), np.zeros(n, bool)
    left = n
    if own >= 0:
        met[own] = True
        left -= 1
    dims = np.flatnonzero(query)
    lists = np.where((query[dims] > 0)[:, None], order[dims, ::-1], order[dims])
    depth, kth = 0, -np.inf
    while left:
        depth = min(n, max(STEP, 2 * depth))
        fresh = np.zeros(n, bool)
        if depth == n or not len(dims):
            fresh[:] = True
        else:
            fresh[lists[:, :depth].ravel()] = True
        fresh &= ~met
        new = np.flatnonzero(fresh)
        scores[new] = vectors[new] @ query
        met |= fresh
        left -= len(new)
        if n - left > k:
            kth = np.partition(scores, -k)[-k]
        if left and (query[dims] * vectors[lists[:, depth - 1], dims]).sum() < kth:
            break
    good = np.flatnonzero(scores >= kth) if np.isfinite(kth) else np.flatnonzero(np.isfinite(scores))
    best = good[np.lexsort((ids[good], -scores[good]))[:k]]
    return best, scores[best]


def _pack(frame: pd.DataFrame) -> pd.DataFrame:
    values = np.stack(frame["v"].to_numpy()).astype(np.float64)
    row = {c: [frame[c].iloc[0]] for c in ("block", "dim")}
    return pd.DataFrame(row | {"rows": [frame["row"].to_numpy(np.int64).tobytes()], "ids": [frame["vec_id"].to_numpy(np.int64).tobytes()], "values": [values.tobytes()]})


def _exact_scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in Python's integers; one beyond a long is the nearest long."""
    whole = lambda x: np.array([int(v) for v in x.ravel()], object).reshape(x.shape)
    limits = np.iinfo(np.int64)
    return np.array([min(max(int(s), limits.min), limits.max) for s in whole(vectors) @ whole(query)], np.int64)


@dataclass
class _Block:
    """Candidates of one dimension: those whose products a double holds, with their lists, and those with large components."""

    rows: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray

    def __post_init__(self):
        largest = np.abs(self.vectors).max(axis=1)
        large = largest >= _LARGE
        self.large = np.flatnonzero(large)
        self.small = np.flatnonzero(~large)
        self.most = largest[self.small].max(initial=0)
        small = self.vectors[self.small]
        self.order = np.ascontiguousarray(np.argsort(small, axis=0, kind="stable").T)
        self.exact, self.short = small, small.astype(np.float32)
        self.place = {r: i for i, r in enumerate(self.rows[self.small].tolist())}

    def best(self, row: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best candidates."""
        bound, found, scores = len(query) * self.most * np.abs(query).max(), [], []
        fits = bound < 1 << 53
        if fits and len(self.small):
            vectors, wanted = (self.short, query.astype(np.float32)) if bound < 1 << 24 else (self.exact, query)  # sums stay exact
            best, score = threshold_search(vectors, self.ids[self.small], self.order, wanted, k, self.place.get(row, -1))
            found, scores = [self.ids[self.small[best]]], [score.astype(np.int64)]
        rest = self.large if fits else np.arange(len(self.rows))
        rest = rest[self.rows[rest] != row]
        if len(rest):
            found.append(self.ids[rest])
            scores.append(_exact_scores(self.vectors[rest], query))
        ids, score = np.concatenate([*found, np.empty(0, np.int64)]), np.concatenate([*scores, np.empty(0, np.int64)])
        top = np.lexsort((ids, ~score))[:k]  # ~score falls as score grows, and never overflows
        return ids[top], score[top]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                x = {c: batch.column(c)[i].as_py() for c in ("c", "dim", "q_rows", "q_ids", "q_values")}
                dim = x["dim"]
                if at != (x["c"], dim):  # its rows follow each other
                    at = (x["c"], dim)
                    rows, ids = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("rows", "ids"))
                    block = _Block(rows, ids, np.frombuffer(batch.column("values")[i].as_py()).reshape(-1, dim))
                queries, query_ids = (np.frombuffer(x[c], np.int64) for c in ("q_rows", "q_ids"))
                out = []
                for q, (row, query) in enumerate(zip(queries.tolist(), np.frombuffer(x["q_values"]).reshape(-1, dim), strict=True)):
                    best, score = block.best(row, query, k)
                    out.append((np.full(len(best), row), np.full(len(best), query_ids[q]), best, score))
                cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["q_row", "query_id", "vec_id", "score"])

    return run


def search(spark: SparkSession, vectors: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products, ties to the smaller id.

    Components are floor(256 x).  Queries are the rows whose id is divisible
    by ``every``; candidates are all other rows than the query's own, of the
    same dimension.  Vectors that are null, empty, or hold a null or non-finite
    component take no part, nor do rows without id; repeated rows are
    candidates of each other; other columns are not read; an empty table gives
    no rows.  Scores are exact for components of any size; one beyond a long
    is the nearest long.
    """
    scaled = F.transform(embedding, lambda x: x.cast("double") * SCALE)
    whole = F.transform(scaled, lambda y: F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y))  # larger ones are whole
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = vectors.where(F.col(embedding).isNotNull() & (F.size(embedding) > 0) & fine & F.col(key).isNotNull())
    table = kernel.materialize(spark, good.select(F.col(key).cast("long").alias("vec_id"), whole.alias("v"), F.size(embedding).alias("dim")).withColumn("row", F.monotonically_increasing_id()))
    n, m = table.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    n_c, n_q = max(1, -(-n // CANDIDATES)), max(1, -(-m // QUERIES))

    def blocks(df: DataFrame, count: int) -> DataFrame:
        dealt = df.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(count)).cast("int"))
        return dealt.groupBy("block", "dim").applyInPandas(_pack, "block int, dim int, rows binary, ids binary, values binary")

    # The stated queries against all rows, block by block: only query blocks are sent more than once.
    candidates = blocks(table, n_c).withColumnRenamed("block", "c")
    queries = blocks(table.where(F.col("vec_id") % every == 0), n_q).select("dim", F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("values").alias("q_values"))
    queries = queries.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))
    pairs = candidates.hint("merge").join(queries, ["c", "dim"])
    found = pairs.mapInArrow(_search(k), "q_row long, query_id long, vec_id long, score long")
    best = W.partitionBy("q_row").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
