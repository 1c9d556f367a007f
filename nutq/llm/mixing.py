"""Mixing sources to target weights.

Every source's words are laid out in one line and packed into blocks of fixed
length.  Each output shard draws how many of its slots every source fills; the
draws are multinomial, conditioned on the sources' totals (which makes them
multivariate hypergeometric), so that the shards are mixed at random and the
totals still meet the targets; they are made by halving, so that a task needs
the counts of no other.  A source's slots are mapped to its blocks by a
pseudorandom permutation of the block numbers, a new one for each pass over the
source, and blocks are joined by number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import kernel

WEIGHTS = (5, 2, 1)
#: No target is above this many times its source's size.
REPEATS = 3
#: Words of a block, of every source.
BLOCK_WORDS = 64
SHARD_SLOTS = 256
#: About so many slots are drawn by one call, shard by shard.
GROUP_SLOTS = 64 * SHARD_SLOTS
#: About so many documents share a place bucket, and so many buckets a block of them.
BUCKET_ROWS, BUCKET_BLOCK = 256, 1024
#: The driver holds a row for each source, and so does a task.
MOST_SOURCES = 100_000
SEED = 20_240_607
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, most: float = REPEATS) -> list[float]:
    """Share all words by weight; no source above ``most`` times its size."""
    total, n = float(sum(sizes)), len(sizes)
    weight = [float(weights[i % len(weights)]) for i in range(n)]
    target, free = [0.0] * n, set(range(n))
    while free:
        left = total - sum(target[i] for i in range(n) if i not in free)
        unit = sum(weight[i] for i in free)
        over = {i for i in free if left * weight[i] / unit > most * sizes[i]}
        for i in over or free:
            target[i] = float(most * sizes[i]) if over else left * weight[i] / unit
        free -= over or free
    return target


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray, rounds: int = 4) -> np.ndarray:
    """A pseudorandom permutation of range(n) for each key: a Feistel network, walked until it lands below n."""
    bits = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out, key = index.astype(np.uint64), key.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> bits[todo], out[todo] & mask[todo]
            for r in range(rounds):
                x = (right + key[todo] + np.uint64(r + 1)) * np.uint64(0x9E3779B97F4A7C15)
                x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                left, right = right, left ^ ((x ^ (x >> np.uint64(32))) & mask[todo])
            out[todo] = left << bits[todo] | right
            todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def _log_factorials(x: np.ndarray) -> np.ndarray:
    big = np.maximum(x, len(_SMALL) - 1).astype(float)
    series = (big + 0.5) * np.log(big) - big + 0.5 * np.log(2 * np.pi) + 1 / (12 * big)
    return np.where(x < len(_SMALL), _SMALL[np.minimum(x, len(_SMALL) - 1)], series)


#: Logarithms of the first factorials.
_SMALL = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 10_001)))])


def _log_ratio(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """log(x! / y!); large factorials are subtracted term by term, so that their size costs no digits."""
    apart, low = (x - y).astype(float), np.maximum(np.minimum(x, y), 1).astype(float)
    a, b = np.maximum(x, 1).astype(float), np.maximum(y, 1).astype(float)
    terms = (a + 0.5) * np.log1p(np.maximum(apart / b, -0.5)) + apart * (np.log(b) - 1) + (1 / a - 1 / b) / 12
    return np.where((low >= len(_SMALL)) & (2 * apart > -b), terms, _log_factorials(x) - _log_factorials(y))


def hypergeometric(rng: np.random.Generator, good: np.ndarray, bad: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many of ``n`` draws without replacement are good ones; element by element, and alike at every size.

    Binomial draws are accepted by the ratio of the two distributions to its
    largest value.  The ratio rises up to (n - 1) * good / (good + bad), then
    falls.  As at most half of all are drawn (else the others are), about two
    of three draws are accepted at worst.
    """
    every = good + bad
    turned = 2 * n > every
    m = np.where(turned, every - n, n)
    out = np.where(good == 0, 0, np.where(bad == 0, m, 0))
    todo = np.flatnonzero((good > 0) & (bad > 0) & (m > 0))
    while len(todo):
        g, b, k = good[todo], bad[todo], m[todo]
        share = g / every[todo]
        best = np.clip(np.floor(share * (k - 1)).astype(np.int64) + 1, np.maximum(0, k - b), np.minimum(k, g))
        drawn = rng.binomial(k, share)
        possible = (drawn <= g) & (k - drawn <= b)
        x = np.where(possible, drawn, best)
        log = _log_ratio(g - best, g - x) + _log_ratio(b - k + best, b - k + x) + (x - best) * (np.log(b) - np.log(g))
        taken = possible & (np.log1p(-rng.random(len(x))) <= log)
        out[todo[taken]] = drawn[taken]
        todo = todo[~taken]
    return np.where(turned, good - out, out)


def split(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` slots, drawn without replacement, fall to each source that has ``left`` of them.

    Sources are the leaves of a binary tree; all nodes of a level share out their draws at once.
    """
    levels = [left]
    while len(levels[-1]) > 1:
        levels[-1] = np.append(levels[-1], np.zeros(len(levels[-1]) % 2, np.int64))
        levels.append(levels[-1][::2] + levels[-1][1::2])
    drawn = np.array([n], np.int64)
    for level in reversed(levels[:-1]):
        drawn = drawn[: len(level) // 2]  # without what was added to make the level even
        first = hypergeometric(rng, level[::2], level[1::2], drawn)
        drawn = np.stack([first, drawn - first], axis=1).ravel()
    return drawn[: len(left)]


def group_counts(slots: np.ndarray, groups: int, first: int, last: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, slots of each source, slots of it in earlier groups) of the groups from ``first`` to before ``last``.

    All slots are halved again and again; a half's draw depends on its place
    only, so every task finds its own groups' counts without the others', and
    neighbours share the halves above them.
    """
    total = int(slots.sum())

    def walk(left: np.ndarray, before: np.ndarray, low: int, high: int):
        if high <= first or low >= last:
            return
        if high - low == 1:
            yield low, left, before
            return
        middle = (low + high) // 2
        take = split(np.random.default_rng([SEED, low, high]), left, total * middle // groups - total * low // groups)
        yield from walk(take, before, low, middle)
        yield from walk(left - take, before + take, middle, high)

    yield from walk(slots, np.zeros_like(slots), 0, groups)


def _draws(slots: list[int], blocks: list[int], groups: int):
    """For each group of shards: draw every shard's source counts and map its slots to blocks."""
    n_slots, n_blocks = np.array(slots, np.int64), np.array(blocks, np.int64)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids = frame["id"]  # neighbours, as they come from one range
            for group, left, at in group_counts(n_slots, groups, int(ids.min()), int(ids.max()) + 1):
                rng, shard = np.random.default_rng([SEED, group]), 0
                while left.sum():
                    take = split(rng, left, min(SHARD_SLOTS, int(left.sum())))
                    source = np.repeat(np.arange(len(take)), take)
                    slot = at[source] + np.arange(len(source)) - np.repeat(np.cumsum(take) - take, take)
                    turn, index = np.divmod(slot, n_blocks[source])
                    block = permute(index, n_blocks[source], source * 1_000_003 + turn + SEED)
                    yield pd.DataFrame({"shard": group * (1 << 32) + shard, "source_ix": source.astype(np.int32), "block": block})
                    left, at, shard = left - take, at + take, shard + 1

    return run


def slots_of(spark: SparkSession, slots: list[int], blocks: list[int]) -> DataFrame:
    """shard, source_ix, block: a row for each slot of the mix."""
    groups = max(1, -(-sum(slots) // GROUP_SLOTS))
    # Enough tasks to deal evenly; each takes as many groups as there are for it.
    tasks = min(groups, max(64, groups // 16))
    return spark.range(0, groups, 1, tasks).mapInPandas(_draws(slots, blocks, groups), "shard long, source_ix int, block long")


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """How often the mix takes each document's words.

    Returns ``keep``, ``size, source_size, target, taken`` and, with
    ``with_text``, the ``text`` that the mix takes from the document: its
    pieces in order and with their white space, each as often as its block is
    used (unchanged if each is used once).  A null text has no words and is
    never taken; a null source is a source, the last one; repeated rows are
    laid out one after another; a kept column named like a made one gives way
    to it; other columns are not read; an empty table gives no rows.  Nothing
    is taken more than ceil(slots / blocks) times, so no document exceeds 3
    times its size.

    The driver holds a row for each source, ``MOST_SOURCES`` at most; more are
    an error.
    """
    columns = [c for c in kernel.kept_columns(keep, "size", "source_size", "target", "taken") if c != "text"]
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    extra = [F.coalesce("text", F.lit("")).alias("text")] if with_text else []
    made = [F.monotonically_increasing_id().alias("_row"), F.col("source").alias("_source"), words.alias("size"), F.xxhash64("doc_id", "text").alias("_mark"), F.col("doc_id").cast("string").alias("_id")]
    sized = kernel.write_table(spark, docs.select(*columns, *made, *extra))
    sources = sized.groupBy("_source").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).limit(MOST_SOURCES + 1).collect()
    if len(sources) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    sources.sort(key=lambda r: (r["_source"] is None, [ord(c) for c in r["_source"] or ""]))
    sizes = [int(r.n) for r in sources]
    target = targets(sizes, weights)
    blocks = [max(1, -(-n // BLOCK_WORDS)) for n in sizes]
    slots = [min(REPEATS * k, round(t * k / n)) if n else 0 for t, k, n in zip(target, blocks, sizes, strict=True)]
    # A row for each source, MOST_SOURCES at most.
    table = F.broadcast(spark.createDataFrame([(r["_source"], i, sizes[i], target[i]) for i, r in enumerate(sources)], "_name string, _ix int, source_size long, target double"))
    joined = sized.join(table, F.col("_source").eqNullSafe(F.col("_name")), "inner").drop("_source", "_name")

    # Where each document starts in its source's line: totals of buckets and blocks of them, then a running sum in each.
    buckets = max(8, sum(r.rows for r in sources) // BUCKET_ROWS)
    narrow = joined.where("size > 0").select("_row", "_id", "size", "_mark", "_ix", F.pmod("_mark", F.lit(buckets)).alias("_bucket"))
    totals = narrow.groupBy("_ix", "_bucket").agg(F.sum("size").alias("_n")).withColumn("_part", F.floor(F.col("_bucket") / BUCKET_BLOCK))

    def before(df: DataFrame, place: str, name: str, *group: str) -> DataFrame:
        line = W.partitionBy(*group).orderBy(place).rowsBetween(W.unboundedPreceding, -1)
        return df.withColumn(name, F.coalesce(F.sum("_n").over(line), F.lit(0)))

    parts = before(totals.groupBy("_ix", "_part").agg(F.sum("_n").alias("_n")), "_part", "_first", "_ix").drop("_n")
    offsets = before(totals, "_bucket", "_next", "_ix", "_part").join(parts, ["_ix", "_part"]).select("_ix", "_bucket", (F.col("_first") + F.col("_next")).alias("_offset"))
    line = W.partitionBy("_ix", "_bucket").orderBy("_mark", "_id", "size", "_row").rowsBetween(W.unboundedPreceding, 0)
    placed = narrow.join(offsets, ["_ix", "_bucket"]).select("_row", "_ix", "size", (F.col("_offset") + F.sum("size").over(line) - F.col("size")).alias("_start"))
    start, size, one = F.col("_start"), F.col("size"), F.lit(BLOCK_WORDS)
    pieces = placed.withColumn("_block", F.explode(F.sequence(F.floor(start / one), F.floor((start + size - 1) / one)))).select(
        "_row", "_ix", "_block", (F.least(start + size, (F.col("_block") + 1) * one) - F.greatest(start, F.col("_block") * one)).alias("_part")
    )
    uses = slots_of(spark, slots, blocks).groupBy(F.col("source_ix").alias("_ix"), F.col("block").alias("_block")).agg(F.count("*").alias("_uses"))
    # The planner takes the slots for as few rows as the groups they come from; they are as many as the blocks.
    used = pieces.join(uses.hint("merge"), ["_ix", "_block"], "left").withColumn("_uses", F.coalesce("_uses", F.lit(0)))
    detail = [F.sort_array(F.collect_list(F.struct("_block", "_part", "_uses"))).alias("_pieces")] * with_text
    by_row = used.groupBy("_row").agg(F.sum(F.col("_part") * F.col("_uses")).cast("long").alias("taken"), *detail)
    # Only here do whole texts move, once.
    whole = joined.join(by_row.hint("merge"), "_row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
    result = [*columns, "size", "source_size", "target", "taken"]
    if not with_text:
        return whole.select(*result)
    whole = whole.select(*result, "text", "_pieces")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (whole.schema[c] for c in result))
    return whole.mapInPandas(_repeat, f"{kept}, text string")


def _repeat(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    word = re.compile(WORD)
    for frame in frames:
        texts = []
        for text, pieces in zip(frame["text"], frame["_pieces"], strict=True):
            if pieces is not None and any(p["_uses"] != 1 for p in pieces):
                begins, at, out = [*(m.start() for m in word.finditer(text)), len(text)], 0, []
                for p in pieces:
                    piece = text[begins[at] : begins[at + p["_part"]]]
                    at += p["_part"]
                    if p["_uses"] > 1 and piece[-1] not in " \t\n\x0b\x0c\r":  # the text's last word
                        piece += " "
                    out.append(piece * p["_uses"])
                text = "".join(out)
            texts.append(text)
        yield frame.drop(columns="_pieces").assign(text=texts)
