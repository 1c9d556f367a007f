"""Language-model scoring with a probabilistic suffix tree over words.

Tokens are words, A-Z lower-cased, and one end for each text.  The root's
distribution is add-one over the training tokens.  A context that occurs
``CONTEXT`` times becomes a state if its next-token distribution diverges from
that of its suffix by ``EVIDENCE`` nats over all its occurrences.  A state lists the
next tokens that follow it ``LISTED`` times, smoothed with its suffix's
distribution, which weighs as many tokens as different ones follow, and one; all
others share what is left, in proportion to the suffix's distribution, so every
distribution sums to one.  A token is scored in the state of its longest
retained suffix.

These counts are absolute, so the tree grows with the corpus.  It is a table: a
*gram* is a context with its next token, and its log10 probability is that of
its suffix plus a term of the context (``rest``: what it leaves to unlisted
tokens), plus, if it is listed, a term of the gram (``gain``).  A gram is the
context of the token after it, so a text's score is the sum of one number for
each of its grams: an equi-join.  It is done by slices of the keys, with packed
rows: a block of texts sends each slice its rare grams in order, the slice reads
its part of the tree and then the blocks, and answers with one sum for each text.  A gram's key is a hash of two others, its context and its
suffix, so only these two are shuffled.  Bounded filters (bit tables, and
sketches of pairs and of triples of words) only spare the shuffles grams that
are surely absent or surely occur once, and the most frequent grams' numbers
are broadcast; neither changes a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel, sketch

#: Words of the longest context.
MOST_DEPTH = 5
#: Least occurrences in training of a context, and of a listed continuation.
CONTEXT = 4
LISTED = 2
#: Least divergence from the suffix's distribution over all occurrences, in nats.
EVIDENCE = 8.0
#: Least share of the training tokens of a word and of a gram whose numbers are broadcast; all others are joined.
NUMBERED = 2e-6
HOT = 2e-7
#: Least share of the training tokens of a context or suffix whose grams are not all dealt to one slice.
ALONE = 1e-4
#: Keys of a packed row at most, and about how many of the tree's grams a task looks up in at once.
PACKED = 1 << 12
SLICE = 1 << 20
#: Grams of so many words and one more are looked up in a sketch before they are shuffled: of these, most occur once.
SKETCHED = 2
#: Deeper grams are found in passes over the texts for so many depths each.
TOGETHER = 3
#: log2 of the bits of the largest bit table.
MOST_BITS = 28
#: Words of it that one task merges.
BIT_SLICE = 1 << 15
END = np.uint64(0xE7D5_0F1E_55ED_C0DE)
_FLUSH = 2_000_000


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a chunk's tokens with the ends, and n + 1 offsets."""
    w = kernel.words(column, lower=True)
    n = np.diff(w.first) + 1
    first = np.concatenate([[0], np.cumsum(n)])
    out = np.full(first[-1], END, np.uint64)
    if len(w.hash):
        out[np.arange(len(w.hash)) + w.doc] = w.hash
    return out, first


def longer(grams: np.ndarray) -> np.ndarray:
    """Grams of one more word, by the places where they end: of the gram that ends one token before, and the one that ends here."""
    out = np.zeros_like(grams)
    out[1:] = kernel.xxhash64(grams[:-1], grams[1:])
    return out


def places(first: np.ndarray) -> np.ndarray:
    """Place of each token in its text."""
    return np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))


def bits(keys: DataFrame, count: int | None = None) -> np.ndarray:
    """Two bits of one word for each of a table's keys; ``has`` is true of every key, and of few other values while the table is not full."""
    size = 1 << min(MOST_BITS, max(16, int(12 * (keys.count() if count is None else count)).bit_length())) - 6
    step = min(size, BIT_SLICE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size, np.uint64)
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            word = np.uint64(1) << (key >> np.uint64(58)) | np.uint64(1) << (key >> np.uint64(52) & np.uint64(63))
            np.bitwise_or.at(own, (key & np.uint64(size - 1)).astype(np.int64), word)
        for first in range(0, size, step):
            at = np.flatnonzero(own[first : first + step])
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([first // step], pa.int32()), pa.array([_planes(at.astype(np.uint32))], pa.binary()), pa.array([own[first + at].tobytes()], pa.binary())], names=["slice", "at", "word"])

    def merged(key, frame):
        import pandas as pd

        out = np.zeros(step, np.uint64)
        for at, word in zip(frame["at"], frame["word"], strict=True):
            out[_numbers_of(at, np.uint32)] |= np.frombuffer(word, np.uint64)
        return pd.DataFrame({"slice": [key[0]], "words": [out.tobytes()]})

    words = np.zeros(size, np.int64)
    with kernel.long_batches(keys.sparkSession):
        for row in keys.select("key").mapInArrow(run, "slice int, at binary, word binary").groupBy("slice").applyInPandas(merged, "slice int, words binary").toLocalIterator():
            words[row.slice * step : (row.slice + 1) * step] = np.frombuffer(row.words, np.int64)
    return words


def has(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    word = words.view(np.uint64)[(keys & np.uint64(len(words) - 1)).astype(np.int64)]
    return (word >> (keys >> np.uint64(58)) & word >> (keys >> np.uint64(52) & np.uint64(63)) & np.uint64(1)).astype(bool)


def _counted(held: list[tuple[np.ndarray, ...]], kept: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The last columns of equal rows, by the first one, and how many rows there are."""
    columns = [np.concatenate(x) for x in zip(*held, strict=True)]
    order = kernel.ascending(columns[0])
    at = kernel.starts(columns[0][order])
    return [c[order[at]] for c in columns[-kept:]], np.diff(at, append=len(order))


def _counter(keys_of, send):
    """What ``send`` makes of depth, suffix, context and n of the grams of every chunk, combined in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def flush():
            for depth, found in held.items():
                (context, suffix), n = _counted(found, 2)
                yield from send(depth, suffix, context, n.astype(np.uint32))

        for batch in batches:
            column = batch.column("text")
            for first, last in kernel.chunks(column):
                for depth, *found in keys_of(column.slice(first, last - first)):
                    held.setdefault(depth, []).append(found)
                    size += len(found[0])
                if size > _FLUSH:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    return run


def _first_look(shape: sketch.Shape, bits: int):
    """Packed key and n of the words, combined in the task, and its share of the sketch of all pairs of words."""
    none = lambda n, schema: [pa.nulls(n, pa.int32() if f.endswith("int") else pa.binary()) for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, touched = [], 0, sketch.Touched(shape)

        def flush():
            if held:
                (key,), n = _counted(held, 1)
                for batch in _rows(_FOUND, key, [key, n.astype(np.uint64)], bits):
                    yield pa.RecordBatch.from_arrays([*batch.columns, *none(batch.num_rows, _PART)], names=[*_ROW, "slice", "packed"])
            for part in touched.flush():
                yield pa.RecordBatch.from_arrays([*none(part.num_rows, _ROWS), *part.columns], names=[*_ROW, "slice", "packed"])

        for batch in batches:
            column = batch.column("text")
            for start, stop in kernel.chunks(column):
                found, first = tokens(column.slice(start, stop - start))
                held.append((found,))
                touched.add(longer(found)[places(first) >= 1])
                size += len(found)
                if size > _FLUSH:
                    yield from flush()
                    held, size = [], 0
        yield from flush()

    return run


_PART = "slice int, packed binary"


def _grams(depths: tuple[int, ...], contexts, listed, shape: sketch.Shape | None, packed):
    """Grams of contexts of so many words that may be listed: depth, gram, context and suffix.

    At the first depth, the context occurs often enough, and the gram's suffix
    is listed; the gram is looked up in the sketch, if there is one.  At the
    others, context and suffix are among the grams found at the depth before.
    """

    def run(column: pa.Array) -> Iterator[tuple]:
        found, first = tokens(column)
        for _ in range(depths[0] - 1):
            found = longer(found)
        place, at = places(first), None
        for depth in depths:
            if at is None:
                at = np.flatnonzero(place >= depth)
                at = at[has(contexts.value, found[at - 1])]
                at = at[has(listed.value, found[at])]
            else:
                before = np.zeros(len(found), bool)
                before[at] = True
                at = at[(place[at] >= depth) & before[at - 1]]
            keys = longer(found)
            key = keys[at]
            if shape:
                often = sketch.levels(shape, packed.value, key) > 0
                at, key = at[often], key[often]
            yield depth, key, found[at - 1], found[at]
            found = keys

    return run


def _sketch(spark: SparkSession, text: DataFrame, size: int, keys_of):
    """Shape and broadcast sketch of the grams that these filters leave."""
    shape = sketch.Shape.of(size, 2)
    every = sketch.build(text, shape, lambda column: (found[1] for a, b in kernel.chunks(column) for found in keys_of(column.slice(a, b - a))))
    kernel.release(spark)
    return shape, spark.sparkContext.broadcast(every)


@dataclass
class Model:
    """Counts of all training tokens (key, n), the numbers of grams (key, n, gain, rest), how many states each depth has, tokens, distinct tokens."""

    vocabulary: DataFrame
    grams: DataFrame
    states: list[int]
    total: int
    distinct: int


#: Columns of packed rows: what a depth's grams, or the grams of the depth before, are, column by column.
_ROWS = "_depth int, _slice int, _kind int, _a binary, _b binary, _c binary, _d binary"
_ROW = ["_depth", "_slice", "_kind", "_a", "_b", "_c", "_d"]
#: Kinds of such rows, in the order in which a slice reads them, and the kinds of numbers of their columns.
_BEFORE, _FOUND = range(2)
_U, _N, _X = np.dtype(np.uint64), np.dtype(np.uint32), np.dtype(np.float64)


def _rows(kind: int, where: np.ndarray, columns: list[np.ndarray], bits: int, depth: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows of one slice (the first bits of ``where``) and of ``PACKED`` entries at most; entries are ordered by ``where``."""
    order = kernel.ascending(where)
    slices = (where[order] >> np.uint64(64 - bits)).astype(np.int32)
    columns = [c[order] for c in columns]
    edges = np.append(kernel.starts(slices), len(slices))
    cuts = [(i, min(i + PACKED, b)) for a, b in zip(edges[:-1], edges[1:], strict=True) for i in range(a, b, PACKED)]
    for first in range(0, len(cuts), 64):
        some = cuts[first : first + 64]
        packed = [pa.array([_planes(c[a:b]) for a, b in some], pa.binary()) for c in columns]
        packed += [pa.nulls(len(some), pa.binary())] * (4 - len(packed))
        yield pa.RecordBatch.from_arrays([pa.array([depth] * len(some), pa.int32()), pa.array(slices[[a for a, _ in some]]), pa.array([kind] * len(some), pa.int32()), *packed], names=_ROW)


def _kept(depth: int, suffix: np.ndarray, context: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Grams of a depth that is grown later."""
    return _rows(_FOUND, suffix, [suffix, context, n], 1, depth)


def _unpacked(batch: pa.RecordBatch, i: int, kinds: tuple[np.dtype, ...]) -> list[np.ndarray]:
    return [_numbers_of(batch.column(c)[i].as_py(), kind) for c, kind in zip(_ROW[3:], kinds, strict=False)]


def _dealer(hot, bits: int):
    """Deals the grams of a depth to the slices of their suffixes; those of a hot suffix, whose numbers every task has, by themselves."""

    def send(depth: int, suffix: np.ndarray, context: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        alone = _Index(hot.value[0]).find(suffix) >= 0
        where = suffix.copy()
        where[alone] = kernel.xxhash64(context[alone], suffix[alone])
        yield from _rows(_FOUND, where, [suffix, context, n], bits)

    return send


def _dealt_later(hot, bits: int):
    """Deals the packed grams of a depth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, send = [], 0, _dealer(hot, bits)
        for batch in batches:
            for i in range(batch.num_rows):
                held.append(_unpacked(batch, i, (_U, _U, _N)))
                size += len(held[-1][0])
                if size > _FLUSH:
                    yield from send(0, *map(np.concatenate, zip(*held, strict=True)))
                    held, size = [], 0
        if size:
            yield from send(0, *map(np.concatenate, zip(*held, strict=True)))

    return run


def _known(kind: int, columns: tuple[str, ...], bits: int):
    """Deals the columns of a table to the slices of its keys, the first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in columns])
            size += batch.num_rows
            if size > _FLUSH:
                every = [*map(np.concatenate, zip(*held, strict=True))]
                yield from _rows(kind, every[0].view(np.uint64), every, bits)
                held, size = [], 0
        if size:
            every = [*map(np.concatenate, zip(*held, strict=True))]
            yield from _rows(kind, every[0].view(np.uint64), every, bits)

    return run


def _by_slice(kinds: tuple[np.dtype, ...], work, last=lambda state: ()):
    """Gives ``work`` the depth before's keys and values of each slice and the entries it got; sends what it yields, and in the end what ``last`` does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, known, held, state = None, [], [], {}

        def done():
            if held:
                keys, values = (np.concatenate(x) for x in zip((np.empty(0, np.uint64), np.empty(0)), *known, strict=True))
                order = kernel.ascending(keys)
                yield from work(keys[order], values[order], *map(np.concatenate, zip(*held, strict=True)), state)

        for batch in batches:
            slices, sorts = batch.column("_slice").to_numpy(), batch.column("_kind").to_numpy()
            for i in range(batch.num_rows):
                if slices[i] != here:
                    yield from done()
                    here, known, held = slices[i], [], []
                if sorts[i] == _BEFORE:
                    known.append(_unpacked(batch, i, (_U, _X)))
                else:
                    held.append(_unpacked(batch, i, kinds))
        yield from done()
        yield from last(state)

    return run


def _added(names: tuple[str, ...]):
    """Of the rows of each key: the largest first number, and the sums of the others; of a single number, the sum."""

    def work(_, __, key, *numbers):
        order = kernel.ascending(key)
        at = kernel.starts(key[order])
        values = [np.add.reduceat(x[order], at) if k or len(names) == 2 else np.maximum.reduceat(x[order], at) for k, x in enumerate(numbers[:-1])]
        yield pa.RecordBatch.from_arrays([pa.array((x.view(np.int64) if x.dtype == _U else x)) for x in (key[order[at]], *values)], names=list(names))

    return _by_slice((_U, _U, _X, _X)[: len(names)], work)


#: Plain rows beside packed ones: sums over what a task has of the hot contexts.
_MET = f"{_ROWS}, context long, told long, kinds long"


def _meeting(hot, bits: int):
    """Counts grams, and finds their suffixes' log; sends context, key, n and that to the slices of the contexts, those of a hot context by themselves."""

    def work(keys, logs, suffix, context, n, state):
        keys_hot, _, logs_hot = hot.value
        key = kernel.xxhash64(context, suffix)
        order = kernel.ascending(key)
        at = kernel.starts(key[order])
        n = np.add.reduceat(n[order].astype(np.int64), at) if len(at) else np.empty(0, np.int64)
        listed = n >= LISTED
        first, n = order[at[listed]], n[listed]
        key, context, suffix = key[first], context[first], suffix[first]
        in_hot, here = _Index(keys_hot).find(suffix), _find(keys, suffix)
        below = np.where(in_hot >= 0, np.append(logs_hot, np.nan)[in_hot], np.append(logs, np.nan)[here])
        there = (in_hot >= 0) | (here >= 0)
        key, context, n, below = key[there], context[there], n[there], below[there]
        is_hot = _Index(keys_hot).find(context)
        alone = is_hot >= 0
        told, kinds = state.setdefault("sums", (np.zeros(len(keys_hot), np.int64), np.zeros(len(keys_hot), np.int64)))
        np.add.at(told, is_hot[alone], n[alone])
        np.add.at(kinds, is_hot[alone], 1)
        for batch in _rows(_FOUND, np.where(alone, key, context), [context, key, n.astype(np.uint64), below], bits):
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.nulls(batch.num_rows, pa.int64())] * 3], names=[*_ROW, "context", "told", "kinds"])

    def last(state):
        if "sums" in state:
            told, kinds = state["sums"]
            at = np.flatnonzero(kinds)
            none = [pa.nulls(len(at), pa.int32())] * 3 + [pa.nulls(len(at), pa.binary())] * 4
            yield pa.RecordBatch.from_arrays([*none, pa.array(hot.value[0][at].view(np.int64)), pa.array(told[at]), pa.array(kinds[at])], names=[*_ROW, "context", "told", "kinds"])

    return _by_slice((_U, _U, _N), work, last)


#: Grams (key, n, log, gain; of a hot context, its key, the suffix's log and the gram's), states (key, n, rest), and of the hot contexts, without a key,
#: a task's sums of the probabilities, of the suffixes' and of the divergence.
_GROWN = "key long, n long, log double, gain double, rest double, context long"


def _diverging(all_, mass, mass_below, listed, evidence: float):
    """Which contexts become states, and their rest."""
    left, left_below = np.maximum(1 - mass, 1e-9), np.maximum(1 - mass_below, 1e-9)
    return all_ * (listed + left * np.log(left / left_below)) >= evidence, np.log10(left / left_below)


def _growing(hot, evidence: float):
    """Decides which contexts become states.  Hot ones are summed up over all tasks first."""

    def rows(size: int, **columns) -> pa.RecordBatch:
        kinds = {f.split()[0]: pa.int64() if f.endswith("long") else pa.float64() for f in _GROWN.split(", ")}
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(size, k) for c, k in kinds.items()], names=list(kinds))

    def longs(x: np.ndarray) -> pa.Array:
        return pa.array(x.view(np.int64))

    def work(keys, counts, context, key, n, below, state):
        keys_hot, all_hot, weight_hot = hot.value
        n, is_hot = n.astype(float), _Index(keys_hot).find(context)
        order = kernel.ascending(context)
        order = order[is_hot[order] < 0]
        at = _find(keys, context[order])
        order, every = order[at >= 0], counts[at[at >= 0]]
        begin = kernel.starts(context[order])
        if len(begin):
            size = np.diff(begin, append=len(order))
            kinds = size + every[begin] - np.add.reduceat(n[order], begin) + 1  # what is not listed follows once
            weight, b, own = np.repeat(kinds, size), below[order], n[order]
            low = 10.0**b
            prob = (own + weight * low) / (every + weight)
            states, rest = _diverging(every[begin], np.add.reduceat(prob, begin), np.add.reduceat(low, begin), np.add.reduceat(prob * np.log(prob / low), begin), evidence)
            log, is_state = np.log10(prob), np.repeat(states, size)
            gain = log - b - np.repeat(rest, size)
            yield rows(len(order), key=longs(key[order]), n=pa.array(own.astype(np.int64)), log=pa.array(np.where(is_state, log, b)), gain=pa.array(gain, mask=~is_state))
            if states.any():
                yield rows(int(states.sum()), key=longs(context[order][begin[states]]), n=pa.array(every[begin[states]].astype(np.int64)), rest=pa.array(rest[states]))
        alone = np.flatnonzero(is_hot >= 0)
        if len(alone):
            of, low, own = is_hot[alone], 10.0 ** below[alone], n[alone]
            prob = (own + weight_hot[of] * low) / (all_hot[of] + weight_hot[of])
            sums = state.setdefault("sums", np.zeros((4, len(keys_hot))))
            sums += [np.bincount(of, x, len(keys_hot)) for x in (prob, low, prob * np.log(prob / low), np.ones(len(of)))]
            yield rows(len(of), key=longs(key[alone]), n=pa.array(own.astype(np.int64)), log=pa.array(below[alone]), gain=pa.array(np.log10(prob)), context=longs(context[alone]))

    def last(state):
        if "sums" in state:
            mass, mass_below, listed, kinds = state["sums"]
            at = np.flatnonzero(kinds)
            yield rows(len(at), context=longs(hot.value[0][at]), log=pa.array(mass[at]), gain=pa.array(mass_below[at]), rest=pa.array(listed[at]))

    return _by_slice((_U, _U, _U, _X), work, last)


def _hot(spark: SparkSession, before: DataFrame, total: int):
    """Broadcast keys in order, n and log of the grams that are so frequent that no slice may get all that they begin or end: 1 / ``ALONE`` at most."""
    found = before.where(F.col("n") >= max(CONTEXT, ALONE * total)).select("key", "n", "log").toArrow()
    key = found.column("key").to_numpy().view(np.uint64)
    order = np.argsort(key)
    return spark.sparkContext.broadcast((key[order], found.column("n").to_numpy()[order].astype(float), found.column("log").to_numpy()[order]))


def _dealt(spark: SparkSession, rows: DataFrame, bits: int) -> DataFrame:
    """Packed rows, each slice in one partition and in the order of kinds."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << bits - 2)
    return rows.repartition(parts, "_slice").sortWithinPartitions("_slice", "_kind")


@dataclass
class _Level:
    """Of a depth: its listed grams' keys (key, n), the same with log, the tree's numbers (key, n, gain, rest), the table of all; counts of grams, of those that may be contexts, of all occurrences and of states."""

    keys: DataFrame
    grams: DataFrame
    numbers: DataFrame | None
    table: DataFrame
    listed: int
    often: int
    size: int
    states: int


def _level(spark: SparkSession, sent: DataFrame, before: DataFrame, hot, bits: int) -> _Level:
    """The next depth, whose packed grams are sent to the slices of their suffixes.

    ``before`` has key, n, log of the depth before: a context's occurrences
    are those of the gram that it is, each followed by a token.
    """
    told = lambda value: before.select("key", F.col(value).cast("double").alias("value")).mapInArrow(_known(_BEFORE, ("key", "value"), bits), _ROWS)
    met = kernel.write_table(spark, _dealt(spark, sent.unionByName(told("log")), bits).mapInArrow(_meeting(hot, bits), _MET))
    keys, every, _ = hot.value
    sums = met.where("context IS NOT NULL").groupBy("context").agg(F.sum("told").alias("told"), F.sum("kinds").alias("kinds")).toArrow()
    at = _find(keys, sums.column("context").to_numpy().view(np.uint64))
    weight = np.ones(len(keys))
    weight[at] = sums.column("kinds").to_numpy() + every[at] - sums.column("told").to_numpy() + 1
    weighed = spark.sparkContext.broadcast((keys, every, weight))
    rows, before = met.where("context IS NULL").select(*_ROW), before.where(F.col("n") >= CONTEXT)
    with kernel.long_batches(spark):
        table = kernel.write_table(spark, _dealt(spark, rows.unionByName(told("n")), bits).mapInArrow(_growing(weighed, EVIDENCE), _GROWN))
    weighed.destroy()
    kernel.drop_table(spark, met)
    sums = table.where("key IS NULL").groupBy("context").agg(*(F.sum(c).alias(c) for c in ("log", "gain", "rest"))).toArrow()
    at = _find(keys, sums.column("context").to_numpy().view(np.uint64))
    diverges, rest = _diverging(every[at], *(sums.column(c).to_numpy() for c in ("log", "gain", "rest")), EVIDENCE)
    at, rest = at[diverges], rest[diverges]
    frequent = spark.createDataFrame(pa.table({"key": keys[at].view(np.int64), "n": every[at].astype(np.int64), "rest": rest}))
    own = table.where("key IS NOT NULL").join(F.broadcast(frequent.select(F.col("key").alias("context"), F.col("rest").alias("left"))), "context", "left")
    is_state, is_gram = F.col("left").isNotNull(), F.col("rest").isNull()
    gain = F.when(is_state, F.col("gain") - F.col("log") - F.col("left")).when(F.col("context").isNull(), F.col("gain"))
    grams = own.where(is_gram).select("key", "n", F.when(is_state, F.col("gain")).otherwise(F.col("log")).alias("log"))
    zero = F.lit(0.0)
    numbers = own.select("key", "n", gain.alias("gain"), "rest").where("gain IS NOT NULL OR rest IS NOT NULL").unionByName(frequent.select("key", "n", zero.alias("gain"), "rest"))
    numbers = numbers.select("key", "n", F.coalesce("gain", zero).alias("gain"), F.coalesce("rest", zero).alias("rest"))
    listed = table.where(F.col("key").isNotNull() & is_gram).select("key", "n")
    n = F.when(is_gram, F.col("n"))
    count = table.where("key IS NOT NULL").agg(F.count(n), F.count(F.when(n >= CONTEXT, 1)), F.coalesce(F.sum(n), F.lit(0)), F.count("rest")).first()
    return _Level(listed, grams, numbers, table, *count[:3], count[3] + len(at))


def model(spark: SparkSession, train: DataFrame, most_depth: int | None = None) -> Model:
    """The tree of a frame of texts, as tables, with contexts of up to ``most_depth`` words (``MOST_DEPTH``).

    Depths are grown one by one.  A depth that lists no gram ends this: every
    gram of the next one would extend one of its grams, so nothing is lost.
    Beyond ``SKETCHED``, grams of ``TOGETHER`` depths are found in one pass.
    """
    text, share = train.select("text"), spark.sparkContext.broadcast
    words = sketch.text_bytes(train) // 6
    shape, slice_bits = sketch.Shape.of(words, 2), max(3, (words // SLICE).bit_length())
    looked = kernel.write_table(spark, text.mapInArrow(_first_look(shape, slice_bits), f"{_ROWS}, {_PART}"))
    vocabulary = _dealt(spark, looked.where("slice IS NULL").select(*_ROW), slice_bits).mapInArrow(_added(("key", "n")), "key long, n long")
    vocabulary = kernel.write_table(spark, vocabulary)
    packed = share(sketch.merge(looked.where("slice IS NOT NULL").select("slice", "packed"), shape))
    kernel.drop_table(spark, looked)
    n = F.col("n")
    total, distinct, listed, often = vocabulary.agg(F.coalesce(F.sum(n), F.lit(0)), F.count("*"), F.count(F.when(n >= LISTED, 1)), F.count(F.when(n >= CONTEXT, 1))).first()
    grams = vocabulary.withColumn("log", F.log10((n + 1) / F.lit(float(total + distinct + 1))))
    before = _Level(vocabulary.where(n >= LISTED), grams, None, vocabulary, listed, often, int(total), 0)
    levels, later, depth, most = [], None, 1, most_depth or MOST_DEPTH
    while depth <= most:
        hot, done = _hot(spark, before.grams, total), []
        if later is None or depth not in later[1]:
            filters = [share(bits(before.keys.where(n >= CONTEXT), before.often)), share(bits(before.keys, before.listed))]
            if 1 < depth <= SKETCHED:
                shape, packed = _sketch(spark, text, before.size, _grams((depth,), *filters, None, None))
            if depth <= SKETCHED:
                sent = text.mapInArrow(_counter(_grams((depth,), *filters, shape, packed), _dealer(hot, slice_bits)), _ROWS)
                done = [*filters, packed]
            else:
                together = tuple(range(depth, min(depth + TOGETHER, most + 1)))
                if later:
                    kernel.drop_table(spark, later[0])
                later = kernel.write_table(spark, text.mapInArrow(_counter(_grams(together, *filters, None, None), _kept), _ROWS)), together
                done = filters
        if later:
            sent = later[0].where(F.col("_depth") == depth).mapInArrow(_dealt_later(hot, slice_bits), _ROWS)
        before = _level(spark, sent, before.grams, hot, slice_bits)
        for value in [*done, hot]:
            value.destroy()  # with the driver's file
        levels.append(before)
        depth += 1
        if not before.listed:
            break
    if later:
        kernel.drop_table(spark, later[0])
    every = spark.createDataFrame([], "key long, n long, gain double, rest double")
    for level in levels:
        every = every.unionByName(level.numbers)  # one scan of each level's table
    # A gram's own row and its row as a context.
    columns = "key", "n", "gain", "rest"
    with kernel.long_batches(spark):
        grams = _dealt(spark, every.mapInArrow(_known(_FOUND, columns, slice_bits), _ROWS), slice_bits)
        grams = kernel.write_table(spark, grams.mapInArrow(_added(columns), "key long, n long, gain double, rest double"))
    for level in levels:
        kernel.drop_table(spark, level.table)
    return Model(vocabulary, grams, [level.states for level in levels], int(total), int(distinct))


def _find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in an ascending table, or -1."""
    if not len(table):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


def _numbers(df: DataFrame, column) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and a number of each."""
    found = df.select("key", column.alias("value")).toArrow()
    key = found.column("key").to_numpy().view(np.uint64)
    order = np.argsort(key)
    return key[order], found.column("value").to_numpy()[order].astype(float)


@dataclass
class Tree:
    """A whole small model in memory."""

    words: np.ndarray  # hashes of all words, ascending
    root: np.ndarray  # log10 probability of each of them
    kept: list[np.ndarray]  # for each depth, true for every state
    keys: np.ndarray
    gain: np.ndarray
    rest: np.ndarray

    def log10(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 probability of each token, given as its place in ``words``; of an unknown one (-1), the part above the root's."""
        found = np.where(ids >= 0, self.words[ids], np.uint64(0))
        out, place = np.where(ids >= 0, self.root[ids], 0.0), places(first)
        for depth in range(1, len(self.kept) + 1):
            at = np.flatnonzero(place >= depth)
            state = _find(self.keys, found[at - 1])
            out[at] += np.where(state >= 0, self.rest[state], 0.0)
            found = longer(found)
            gram = _find(self.keys, found[at])
            out[at] += np.where(gram >= 0, self.gain[gram], 0.0)
        return out


def learn(spark: SparkSession, train: DataFrame) -> tuple[Tree, DataFrame, int, int]:
    """(tree, counts of all training tokens as key, n; number of tokens; distinct tokens) of a frame of few texts: the model is collected."""
    m = model(spark, train)
    words, root = _numbers(m.vocabulary, F.log10((F.col("n") + 1) / F.lit(float(m.total + m.distinct + 1))))
    (keys, gain), (_, rest) = (_numbers(m.grams, F.col(c)) for c in ("gain", "rest"))
    return Tree(words, root, [np.ones(n, bool) for n in m.states], keys, gain, rest), m.vocabulary, m.total, m.distinct


class _Index:
    """Places of values in ascending keys that are spread evenly: a table by their first bits, then a few steps."""

    def __init__(self, keys: np.ndarray):
        bits = max(1, len(keys).bit_length())
        self.keys, self.shift = keys, np.uint64(64 - bits)
        first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift)
        self.first = np.append(first, len(keys)).astype(np.int32)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, or -1."""
        bucket = (values >> self.shift).astype(np.int64)
        at, end, out = self.first[bucket], self.first[bucket + 1], np.full(len(values), -1, np.int64)
        left = np.flatnonzero(at < end)
        at, end, values = at[left], end[left], values[left]
        while len(left):
            hit = self.keys[at] == values
            out[left[hit]] = at[hit]
            at = at + 1
            on = ~hit & (at < end)
            left, at, end, values = left[on], at[on], end[on], values[on]
        return out


#: Kinds of the rows that a slice of the keys gets, in the order in which it reads them: its part of the words' counts
#: and of the tree, the rare words and grams of blocks of texts, and rows of texts, which pass through.
_WORDS, _TREE, _RARE, _GRAMS, _TEXT = range(5)
_PACK = ["_slice", "_kind", "_start", "_keys", "_data"]
#: Texts of a part, whose answers are packed in a row of each task, as a power of 2, and the columns of such rows.
PART_BITS = 12
_SUMS = ["_part", "_rows", "_tail", "_unknown", "_above"]
_PACK_SCHEMA = "_slice int, _kind int, _start long, _keys binary, _data binary"


def _planes(values: np.ndarray) -> bytes:
    """The bytes of numbers, all lowest ones first: the high ones of small numbers are zeros in a row, which a shuffle compresses."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _numbers_of(data: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _packs(kind: int, start: int, keys: np.ndarray, data: np.ndarray, bits: int) -> Iterator[list[pa.Array]]:
    """Keys in order, as differences, with what belongs to each: rows of one slice (the first bits of the keys) and of ``PACKED`` keys at most."""
    order = kernel.ascending(keys)
    keys, data = keys[order], data[order]
    slices = (keys >> np.uint64(64 - bits)).astype(np.int32)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(slices)) + 1, [len(keys)]])
    cuts = [(i, min(i + PACKED, b)) for a, b in zip(edges[:-1], edges[1:], strict=True) for i in range(a, b, PACKED)]
    for first in range(0, len(cuts), 64):
        some = cuts[first : first + 64]
        yield [
            pa.array(slices[[a for a, _ in some]]),
            pa.array([kind] * len(some), pa.int32()),
            pa.array([start] * len(some), pa.int64()),
            pa.array([_planes(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in some], pa.binary()),
            pa.array([_planes(data[a:b]) for a, b in some], pa.binary()),
        ]


def _table_packer(kind: int, bits: int):
    """Packs a table of keys and numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            keys, values = (np.concatenate(x) for x in zip(*held, strict=True))
            for columns in _packs(kind, 0, keys, values, bits):
                yield pa.RecordBatch.from_arrays(columns, names=_PACK)

        for batch in batches:
            held.append((batch.column("key").to_numpy().view(np.uint64), batch.column("value").to_numpy()))
            size += batch.num_rows
            if size > _FLUSH:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return run


def _scorer(words, hot, cold, depth: int, keep: list[str], bits: int):
    """Sends a row for each text, scored as far as broadcast numbers go, and the rare words and grams of blocks of texts, packed."""
    own = [*keep, "_row", "n_tokens", "_base", "_model"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (numbered, root), (keys, value) = words.value, hot.value
        root, value = np.append(root, 0.0), np.append(value, 0.0)  # the last is for what isn't found
        numbered, keys = _Index(numbered), _Index(keys)
        at = begun = TaskContext.get().partitionId() << 33
        held, size, kinds = {_RARE: [], _GRAMS: []}, 0, []

        def flush():
            for kind, found in held.items():
                if found:
                    for columns in _packs(kind, begun, *(np.concatenate(x) for x in zip(*found, strict=True)), bits):
                        yield pa.RecordBatch.from_arrays([*[pa.nulls(len(columns[0]), k) for k in kinds], *columns], names=[*own, *_PACK])
                    found.clear()

        for batch in batches:
            column = batch.column("text")
            kinds = [*(batch.column(c).type for c in keep), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            for start, stop in kernel.chunks(column):
                found, first = tokens(column.slice(start, stop - start))
                low, n = first[:-1], stop - start
                ids = numbered.find(found)
                base = np.add.reduceat(root[ids], low)
                doc, place = np.repeat(np.arange(n), np.diff(first)), places(first)
                row = (doc + (at - begun)).astype(np.uint32)
                rare = ids < 0
                held[_RARE].append((found[rare], row[rare]))
                size += len(held[_RARE][-1][0])
                above, grams = np.zeros(n), found
                for d in range(depth + 1):
                    grams = longer(grams) if d else grams
                    known = np.flatnonzero(place >= d)
                    known = known[has(cold.value, grams[known])]
                    there = keys.find(grams[known])
                    above += np.bincount(doc[known], value[there], n)
                    other = known[there < 0]
                    held[_GRAMS].append((grams[other], row[other]))
                    size += len(other)
                rows, ids = batch.slice(start, n), np.arange(at, at + n)
                none = [pa.nulls(n, k) for k in (pa.int64(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [*map(rows.column, keep), pa.array(ids), pa.array(np.diff(first).astype(np.int64)), pa.array(base), pa.array(base + above), pa.array((ids % (1 << bits)).astype(np.int32)), pa.array(np.full(n, _TEXT, np.int32)), *none],
                    names=[*own, *_PACK],
                )
                at += n
                if size > _FLUSH:
                    yield from flush()
                    begun, size = at, 0
        yield from flush()

    return run


def _answers(own: list[str], unseen: float):
    """Reads slices one after another, each in the order of kinds; sends sums over what was looked up by text, packed by parts of the texts, and lets rows of texts pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, tables, held, size = None, {}, [], 0

        def summed(found):
            """One entry for each text."""
            row, of = np.unique(found[0], return_inverse=True)
            return [row, *(np.bincount(of, x) for x in found[1:])]

        def answer(found, batch):
            row, tail, unknown, above = found
            edges = np.concatenate([[0], np.flatnonzero(np.diff(row >> PART_BITS)) + 1, [len(row)]])
            cuts = list(zip(edges[:-1], edges[1:], strict=True))
            for first in range(0, len(cuts), 64):
                some = cuts[first : first + 64]
                packed = [pa.array([x[i:j].tobytes() for i, j in some], pa.binary()) for x in ((row & (1 << PART_BITS) - 1).astype(np.uint16), tail, unknown.astype(np.uint32), above)]
                yield pa.RecordBatch.from_arrays([*[pa.nulls(len(some), batch.column(c).type) for c in own], pa.array(row[[i for i, _ in some]] >> PART_BITS), *packed], names=[*own, *_SUMS])

        def table(kind):
            """Keys in order and numbers of this slice, with one more number for what isn't there."""
            parts = tables.get(kind, [])
            if len(parts) != 1:
                keys = np.concatenate([np.empty(0, np.uint64), *(k for k, _ in parts)])
                order = kernel.ascending(keys)
                tables[kind] = parts = [(keys[order], np.concatenate([np.empty(0), *(v for _, v in parts)])[order])]
            return parts[0]

        for batch in batches:
            kinds = batch.column("_kind").to_numpy()
            texts = batch.filter(pa.array(kinds == _TEXT))
            if texts.num_rows:
                part = pa.array(texts.column("_row").to_numpy() >> PART_BITS)
                yield pa.RecordBatch.from_arrays([*map(texts.column, own), part, *[pa.nulls(texts.num_rows, pa.binary())] * 4], names=[*own, *_SUMS])
            slices, starts, packed, data = (batch.column(c) for c in ("_slice", "_start", "_keys", "_data"))
            rows, tail, unknown, above = [], [], [], []
            for i in np.flatnonzero(kinds != _TEXT):
                if here != slices[i].as_py():
                    here, tables = slices[i].as_py(), {}
                keys, numbers = np.cumsum(_numbers_of(packed[i].as_py(), np.uint64)), data[i].as_py()
                if kinds[i] in (_WORDS, _TREE):
                    tables.setdefault(kinds[i], []).append((keys, _numbers_of(numbers, np.float64)))
                    continue
                known, value = table(_WORDS if kinds[i] == _RARE else _TREE)
                at, none = _find(known, keys), np.zeros(len(keys))
                value = np.append(value, unseen if kinds[i] == _RARE else 0.0)[at]
                rows.append(_numbers_of(numbers, np.uint32) + np.int64(starts[i].as_py()))
                for sent, what in ((tail, value if kinds[i] == _RARE else none), (unknown, at < 0 if kinds[i] == _RARE else none), (above, none if kinds[i] == _RARE else value)):
                    sent.append(what)
            if rows:
                held.append(summed([np.concatenate(x) for x in (rows, tail, unknown, above)]))
                size += len(held[-1][0])
            if size > _FLUSH:
                held = [summed([np.concatenate(x) for x in zip(*held, strict=True)])]
                size = len(held[0][0])
                if size > _FLUSH // 2:
                    yield from answer(held.pop(), batch)
                    size = 0
        if held:
            yield from answer(summed([np.concatenate(x) for x in zip(*held, strict=True)]), batch)

    return run


def _totals(own: list[str]):
    """Adds what all slices answer to each part of the texts, and then completes the rows of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, sums = None, np.zeros((3, 1 << PART_BITS))
        for batch in batches:
            part, is_text = batch.column("_part").to_numpy(), batch.column("n_tokens").is_valid().to_numpy(zero_copy_only=False)
            rows, *packed = (batch.column(c) for c in _SUMS[1:])
            edges = np.concatenate([[0], np.flatnonzero((np.diff(part) != 0) | (np.diff(is_text) != 0)) + 1, [len(part)]])
            for first, last in zip(edges[:-1], edges[1:], strict=True):
                if part[first] != here:
                    here, sums[:] = part[first], 0
                if is_text[first]:
                    texts = batch.slice(first, last - first)
                    tail, unknown, above = sums[:, texts.column("_row").to_numpy() & (1 << PART_BITS) - 1]
                    yield pa.RecordBatch.from_arrays([*map(texts.column, own), pa.array(tail), pa.array(unknown.astype(np.int64)), pa.array(above)], names=[*own, *_SUMS[2:]])
                    continue
                for i in range(first, last):
                    at = np.frombuffer(rows[i].as_buffer(), np.uint16)
                    for total, data, kind in zip(sums, packed, (np.float64, np.uint32, np.float64), strict=True):
                        total[at] += np.frombuffer(data[i].as_py(), kind)

    return run


def score(spark: SparkSession, docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), modulus: int = 7, held: int = 2, most_depth: int | None = None) -> DataFrame:
    """Score every whole text: ``keep``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learns from rows whose crc32 of the id, modulo ``modulus``, is not
    ``held``.  A null or empty text is one end token; a null id counts as
    empty text where the remainder is taken; repeated rows are learnt and
    scored each; other columns are not read; an empty table gives no rows.
    Words and grams are told apart by 64 bits of hash.
    """
    keep = kernel.without_made(keep, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    text = kernel.text_column(docs.withColumn("held_out", kernel.remainder("doc_id", modulus) == held), *keep, "held_out")
    m = model(spark, text.where("NOT held_out"), most_depth)
    kernel.release(spark)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (text.schema[c] for c in [*keep, "held_out"]))
    prior = lambda n: F.log10((n + 1) / F.lit(float(m.total + m.distinct + 1)))
    value = F.col("gain") + F.col("rest")
    share = spark.sparkContext.broadcast
    numbered = F.col("n") >= max(2, NUMBERED * m.total)
    words = share(_numbers(m.vocabulary.where(numbered), prior(F.col("n"))))  # 1 / NUMBERED rows at most
    hot = share(_numbers(m.grams.where(F.col("n") >= HOT * m.total), value))
    count = m.grams.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), count // SLICE)
    slice_bits = (4 * parts).bit_length()
    made = f"{kept}, _row long, n_tokens long, _base double, _model double"
    own = [*keep, "held_out", "_row", "n_tokens", "_base", "_model"]
    cold = share(bits(m.grams, count))
    sent = text.mapInArrow(_scorer(words, hot, cold, len(m.states), [*keep, "held_out"], slice_bits), f"{made}, {_PACK_SCHEMA}")
    told = m.vocabulary.where(~numbered).select("key", prior(F.col("n")).alias("value")), m.grams.where(F.col("n") < HOT * m.total).select("key", value.alias("value"))
    for kind, table in zip((_WORDS, _TREE), told, strict=True):
        sent = sent.unionByName(table.mapInArrow(_table_packer(kind, slice_bits), _PACK_SCHEMA), allowMissingColumns=True)
    dealt = sent.repartition(parts, "_slice").sortWithinPartitions("_slice", "_kind")
    unseen = -float(np.log10(m.total + m.distinct + 1))
    found = kernel.write_table(spark, dealt.mapInArrow(_answers(own, unseen), f"{made}, _part long, _rows binary, _tail binary, _unknown binary, _above binary"))
    for done in (m.vocabulary, m.grams):
        kernel.drop_table(spark, done)
    for done in (words, hot, cold):
        done.destroy()
    parted = found.repartition(parts, "_part").sortWithinPartitions("_part", F.col("n_tokens").isNotNull())
    whole = parted.mapInArrow(_totals(own), f"{made}, _tail double, _unknown long, _above double")
    return whole.select(
        *keep, "held_out", "n_tokens", (F.col("n_tokens") - F.col("_unknown")).alias("n_known"), F.lit(m.total).cast("long").alias("train_tokens"), (F.col("_base") + F.col("_tail")).alias("base_score"), (F.col("_model") + F.col("_tail") + F.col("_above")).alias("score")
    )
