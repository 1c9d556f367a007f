"""Quality classifier over document statistics.

Random Fourier features approximate a Gaussian kernel over a few statistics of
each whole text.  Every partition sums its share of the normal equations; the
sums are added in a tree, one small ridge system is solved, and an isotonic
regression over bins of the ridge score turns it into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel

#: Statistics of a text.
STATISTICS = 20
#: Words of a segment; the worst segment of a text has statistics of its own.
SEGMENT = 50
FEATURES = 256
RIDGE = 1.0
BINS = 2000
#: Partitions whose shares of the normal equations one task adds up.
FAN = 16
SEED = 20_240_609
#: Standard deviations beyond which a statistic is cut off.
REACH = 5.0


def statistics(column: pa.Array) -> np.ndarray:
    """A row of statistics for each text of a chunk."""
    w = kernel.words(column)
    raw, n_docs = w.raw, len(w.first) - 1
    n = np.diff(w.first)

    def bytes_in(low: int, high: int) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum((raw >= low) & (raw <= high))])
        return sums[w.end] - sums[w.start]

    def symbols(chars: bytes) -> np.ndarray:
        table = np.zeros(256, bool)
        table[list(chars)] = True
        sums = np.concatenate([[0], np.cumsum(table[raw])])
        return (sums[w.end] - sums[w.start]) > 0

    size = w.end - w.start
    upper, lower, digit = bytes_in(65, 90), bytes_in(97, 122), bytes_in(48, 57)
    again = np.zeros(len(size), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    per_word = [
        again,
        (lower == 0) & (upper >= 2),
        symbols(b"!?"),
        symbols(b"|\\/_~^<>{}[]=+"),
        symbols(b"%$&*#@"),
        digit > 0,
        symbols(b".,;:"),
        (upper == 0) & (lower == 0) & (digit == 0),
    ]
    place = np.arange(len(size)) - w.first[w.doc]
    starts = np.flatnonzero(place % SEGMENT == 0)
    of = w.doc[starts]
    full = np.minimum(SEGMENT, n[of])
    out = np.zeros((n_docs, STATISTICS))
    some = np.maximum(n, 1)
    for k, flag in enumerate(per_word):
        out[:, 2 * k] = np.bincount(w.doc, flag, n_docs) / some
        if len(starts):
            np.maximum.at(out[:, 2 * k + 1], of, np.add.reduceat(flag.astype(float), starts) / full)
    new = np.zeros(len(size), bool)
    if len(size):
        order = np.lexsort((w.hash, w.doc))
        new[order[1:]] = (w.hash[order][1:] != w.hash[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1])
        new[order[0]] = True
    distinct = np.bincount(w.doc, new, n_docs)
    out[:, -4] = np.log1p(n)
    out[:, -3] = np.log1p(distinct) - np.log1p(n)
    out[:, -2] = np.bincount(w.doc, size, n_docs) / some
    out[:, -1] = np.bincount(w.doc, np.minimum(size, 60) ** 2, n_docs) ** 0.5 / some**0.5
    return out


def _statistics(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for first, last in kernel.chunks(column):
                values = statistics(column.slice(first, last - first))
                rows = batch.slice(first, last - first)
                at = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
                yield pa.RecordBatch.from_arrays([*map(rows.column, keep), pa.ListArray.from_arrays(pa.array(at), pa.array(values.ravel()))], names=[*keep, "_stats"])

    return run


def _expand(values: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features, and a constant."""
    rng = np.random.default_rng(SEED)
    x = np.clip((values - mean) / scale, -REACH, REACH)
    d = x.shape[1]
    turn = rng.normal(0, 1 / np.sqrt(2 * d), (d, FEATURES))
    phase = rng.uniform(0, 2 * np.pi, FEATURES)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(x @ turn + phase), np.ones((len(x), 1))])


def _array(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _normal_equations(mean: np.ndarray, scale: np.ndarray):
    """A partition's share of the normal equations, one row of the matrix a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((FEATURES + 1, FEATURES + 2)), False
        for batch in batches:
            if batch.num_rows:
                z, some = _expand(_array(batch.column("stats")), mean, scale), True
                total += z.T @ np.hstack([z, batch.column("label").to_numpy()[:, None]])
        if some:
            at = np.arange(FEATURES + 2, dtype=np.int32) * (FEATURES + 2)
            part = np.full(FEATURES + 1, TaskContext.get().partitionId())
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.arange(FEATURES + 1)), pa.ListArray.from_arrays(pa.array(at), pa.array(total.ravel()))], names=["part", "row", "sums"])

    return run


def _add(key, frame):
    import pandas as pd

    return pd.DataFrame({"part": [key[0]], "row": [key[1]], "sums": [np.sum(frame["sums"].to_numpy())]})


def tree_sum(shares: DataFrame, parts: int) -> DataFrame:
    """Sum rows ``part, row, sums`` by ``row``, FAN partitions at a time, level by level."""
    while parts > 1:
        parts = -(-parts // FAN)
        shares = shares.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("part", "row").applyInPandas(_add, "part long, row long, sums array<double>")
    return shares


def isotonic(value: np.ndarray, hits: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the middles of the blocks and their rates."""
    blocks: list[list[float]] = []
    for v, h, c in zip(value, hits, count, strict=True):
        blocks.append([v * c, h, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    arr = np.array(blocks)
    return arr[:, 0] / arr[:, 2], (arr[:, 1] + 0.02) / (arr[:, 2] + 0.04)


def _train_scores(mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                value = _expand(_array(batch.column("stats")), mean, scale) @ weights
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(value)], names=["label", "score"])

    return run


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    x: np.ndarray
    y: np.ndarray


def _apply(keep: list[str], model: dict | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**model) if model else None
        for batch in batches:
            if batch.num_rows:
                score = np.interp(_expand(_array(batch.column("_stats")), m.mean, m.scale) @ m.weights, m.x, m.y) if m else np.full(batch.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays([*map(batch.column, keep), pa.array(score)], names=[*keep, "score"])

    return run


def fit(spark: SparkSession, train: DataFrame, labels: DataFrame, label: str) -> Model | None:
    """The model of ``doc_id, stats`` rows and their labels; None where there are not two classes."""
    truth = labels.where(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("double").alias("label"))
    known = kernel.materialize(spark, train.join(truth, "doc_id").select("stats", "label"))
    sums = known.agg(F.count("*"), F.sum("label"), *[f(F.col("stats")[i]) for i in range(STATISTICS) for f in (F.avg, F.stddev_pop)]).first()
    if not sums[0] or sums[1] in (0, sums[0]):
        return None
    mean, scale = np.array(sums[2::2]), np.array(sums[3::2])
    scale = np.where(scale > 1e-9, scale, 1.0)
    shares = known.mapInArrow(_normal_equations(mean, scale), "part long, row long, sums array<double>")
    rows = tree_sum(shares, known.rdd.getNumPartitions()).orderBy("row").collect()  # FEATURES + 1 rows
    total = np.array([r.sums for r in rows])
    ridge = np.full(FEATURES + 1, RIDGE)
    ridge[-1] = 0
    weights = np.linalg.solve(total[:, :-1] + np.diag(ridge), total[:, -1])
    scored = known.mapInArrow(_train_scores(mean, scale, weights), "label double, score double")
    bins = F.least(F.greatest(F.floor((F.col("score") + 1) * (BINS / 3)), F.lit(0)), F.lit(BINS - 1))
    curve = scored.groupBy(bins.alias("bin")).agg(F.avg("score").alias("v"), F.sum("label").alias("h"), F.count("*").alias("c")).orderBy("bin").collect()
    return Model(mean, scale, weights, *isotonic(*(np.array([r[k] for r in curve], float) for k in "vhc")))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "quality", keep: tuple[str, ...] = ("doc_id",), modulus: int = 3, held: int = 1) -> DataFrame:
    """Score every whole text: ``keep``, ``held_out``, ``score``, ``predicted``.

    Labels are learnt from rows whose crc32 of the id, modulo ``modulus``, is
    not ``held``; label, language, source and id are no inputs.  Statistics
    are taken of every text once, to a table, which is learnt from and scored.
    A null text counts as empty and is scored like any other; a null id is
    never held out and has no label; labels that are null are passed over;
    repeated rows are scored each; a kept column named like a made one gives
    way to it; other columns are not read; an empty table gives no rows.  With
    labels of one class or none to learn from, every score is 0.5.
    """
    columns = [*kernel.kept_columns(keep, "held_out", "score", "predicted"), "held_out"]
    text = kernel.text_column(docs.withColumn("held_out", kernel.remainder("doc_id", modulus) == held), *columns)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (text.schema[c] for c in columns))
    table = kernel.write_table(spark, text.mapInArrow(_statistics(columns), f"{kept}, _stats array<double>"))
    model = fit(spark, table.where("NOT held_out").select("doc_id", F.col("_stats").alias("stats")), labels, label)
    scored = table.mapInArrow(_apply(columns, model and vars(model)), f"{kept}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
