"""Elements of one big JSON array, read in byte ranges.

Files are read in pieces that end at ``}``; no escape crosses such an end.  Of
each split a first pass tells how it changes the state it is entered with:
whether it turns string inside out, and the change of depth for either case.
The composed changes of the splits before tell where a split starts.  A second
pass finds the array, counts the elements of each split, and keeps what isn't a
whole piece: the text around the array, and parts of elements whose strings or
objects hold a ``}``.  These are put together; all other elements are read by
the third pass where they lie.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .lines import ordered_rows
from .shared import by_split, checkpointed

_OPEN, _CLOSE = (ord("{"), ord("[")), (ord("}"), ord("]"))
_PIECE = "file string, block long, row long, piece int, array int, number long, kind string, closes boolean, text string"
#: Kinds of pieces: around arrays, an array opens (text is 1 for the one sought), a whole element, a part of one, whole ones counted, a ``}`` that the file has not.
_AROUND, _OPENS, _WHOLE, _PART, _COUNT, _ADDED = "around", "opens", "whole", "part", "count", "added"


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = column.cast(pa.large_string()).buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def _quotes(raw: np.ndarray) -> np.ndarray:
    """Where strings begin or end: quotes after an even number of backslashes."""
    quote = raw == ord('"')
    slash = raw == ord("\\")
    if slash.any():
        place = np.arange(len(raw))
        other = np.maximum.accumulate(np.where(slash, -1, place))
        run = np.zeros(len(raw), np.int64)
        run[1:] = place[:-1] - other[:-1]
        quote &= run % 2 == 0
    return quote


def _steps(raw: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """Per byte: whether it lies in a string, and its change of depth if it does not (if it does: were it not)."""
    quote = _quotes(raw)
    within = (np.cumsum(quote) - quote + inside) % 2 == 1
    return within, np.isin(raw, _OPEN).astype(np.int64) - np.isin(raw, _CLOSE)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, block, first row, end): consecutive rows of one split."""
    keys = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True))
    first = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[first]:
            yield *keys[first], first, i
            first = i


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split: what it does to a state, its bytes, and its first character that is no space."""
    names = ["file", "block", "flips", "outside", "inside", "size", "top", "real"]
    held: list | None = None
    pack = lambda row: pa.RecordBatch.from_arrays([pa.array([x], pa.string() if n in ("file", "top") else pa.int64()) for n, x in zip(names, row, strict=True)], names=names)
    for batch in batches:
        raw, at = _bytes(batch.column("value"))
        for file, block, first, end in _runs(batch):
            part = raw[at[first] : at[end]]
            if held is None or held[:2] != [file, block]:
                if held:
                    yield pack(held)
                held = [file, block, 0, 0, 0, 0, None, batch.column("real")[first].as_py()]
            within, delta = _steps(part, 0)
            out, inner = int(delta[~within].sum()), int(delta[within].sum())
            if held[2]:
                out, inner = inner, out
            held[2] = (held[2] + int(_quotes(part).sum())) % 2
            held[3] += out
            held[4] += inner
            held[5] += len(part)
            if held[6] is None:
                rest = part.tobytes().lstrip(b" \t\r\n\xef\xbb\xbf")
                held[6] = chr(rest[0]) if rest else None
    if held:
        yield pack(held)


class _Split:
    """Walks through the pieces of one split."""

    def __init__(self, file: str, block: int, inside: int, depth: int, base: int, key: str):
        self.file, self.block, self.inside, self.depth, self.base = file, block, inside, depth, base
        self.row = self.array = self.number = 0
        self.key = re.compile(rb'(?<!\\)"' + key.encode() + rb'"\s*:\s*$')
        self.out: list[tuple] = []

    def put(self, piece: int, kind: str, text: str | None, closes: bool = False, number: int | None = None) -> None:
        self.out.append((self.file, self.block, self.row, piece, self.array, self.number if number is None else number, kind, closes, text))

    def walk(self, data: bytes, brackets: list[tuple[int, int]], inside: bool, depth: int) -> None:
        """One piece whose brackets outside of strings are given; the state at its beginning, too."""
        base, cut, piece, whole = self.base, 0, 0, not inside and depth == self.base
        for place, code in brackets:
            if code in _OPEN:
                depth += 1
                if depth == base:
                    self.put(piece, _AROUND, data[cut : place + 1].decode())
                    self.array, self.number, cut, whole = self.array + 1, 0, place + 1, True
                    sought = code == ord("[") and (base == 1 or bool(self.key.search(data, 0, place)))
                    self.put(piece + 1, _OPENS, str(int(sought)))
                    piece += 2
            elif depth == 0:
                if place == len(data) - 1:  # the end that was added to the file's last piece, or one too many
                    self.put(piece, _AROUND, data[cut:place].decode())
                    self.put(piece + 1, _ADDED, None)
                    cut, piece = place + 1, piece + 2
            else:
                depth -= 1
                if depth == base - 1:
                    self.put(piece, _PART, data[cut:place].decode())
                    cut, piece = place, piece + 1
                elif depth == base and code == ord("}"):
                    self.put(piece, _WHOLE if whole else _PART, data[cut : place + 1].decode(), True)
                    self.number += 1
                    cut, piece, whole = place + 1, piece + 1, True
        if cut < len(data):
            self.put(piece, _PART if depth >= base else _AROUND, data[cut:].decode())


def _pieces(key: str, elements: bool):
    """The pieces of all splits; with ``elements`` only whole elements, without them whole ones are only counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.string()]
        names = ["file", "block", "row", "piece", "array", "number", "kind", "closes", "text"]
        split: _Split | None = None
        for batch in batches:
            raw, at = _bytes(batch.column("value"))
            made: list[pa.RecordBatch] = []
            for file, block, first, end in _runs(batch):
                if split is None or (split.file, split.block) != (file, block):
                    split = _Split(file, block, *(batch.column(c)[first].as_py() for c in ("inside", "depth", "base")), key)
                part, edge = raw[at[first] : at[end]], at[first : end + 1] - at[first]
                within, delta = _steps(part, split.inside)
                delta = np.where(within, 0, delta)
                after = split.depth + np.cumsum(delta)
                depth = np.append(split.depth, after[edge[1:] - 1])
                lowest = np.minimum.reduceat(after, edge[:-1])
                base = split.base
                simple = ~within[edge[:-1]] & ~within[edge[1:] - 1] & (depth[:-1] == base) & (depth[1:] == base) & (lowest >= base)
                brackets = np.flatnonzero(delta)
                bounds = np.searchsorted(brackets, edge)
                rows, places, arrays, numbers = [], [], [], []

                def whole(a: int, b: int, split=split, rows=rows, places=places, arrays=arrays, numbers=numbers, first=first) -> None:
                    """Pieces from a to b are whole elements."""
                    if elements:
                        rows.append(np.arange(first + a, first + b))
                        places.append(split.row + np.arange(b - a))
                        arrays.append(np.full(b - a, split.array))
                        numbers.append(split.number + np.arange(b - a))
                    elif b > a:
                        split.put(0, _COUNT, None, number=b - a)
                    split.number += b - a
                    split.row += b - a

                done = 0
                for i in np.flatnonzero(~simple).tolist():
                    whole(done, i)
                    data = part[edge[i] : edge[i + 1]].tobytes()
                    mine = brackets[bounds[i] : bounds[i + 1]]
                    split.walk(data, list(zip((mine - edge[i]).tolist(), part[mine].tolist(), strict=True)), bool(within[edge[i]]), int(depth[i]))
                    split.row += 1
                    done = i + 1
                whole(done, end - first)
                split.inside = (split.inside + int(_quotes(part).sum())) % 2
                split.depth = int(depth[-1])
                if elements and rows:
                    took = np.concatenate(rows)
                    same = lambda x, kind, n=len(took): pa.array([x] * n, kind)
                    cols = [same(file, kinds[0]), same(block, kinds[1]), pa.array(np.concatenate(places)), same(0, kinds[3]), pa.array(np.concatenate(arrays), kinds[4]), pa.array(np.concatenate(numbers)), same(_WHOLE, kinds[6]), same(True, kinds[7]), batch.column("value").take(pa.array(took))]
                    made.append(pa.RecordBatch.from_arrays(cols, names=names))
                out = [x for x in split.out if not elements or x[6] == _WHOLE]
                if not elements:  # a whole element of a piece with more in it is counted here and read by the third pass
                    out = [x if x[6] != _WHOLE else (*x[:5], 1, _COUNT, False, None) for x in out]
                if out:
                    made.append(pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names))
                split.out.clear()
            yield from made

    return run


def _problems(batches):
    """Files whose text around the array is no JSON."""
    for frame in batches:
        bad = []
        for file, text, added, more in zip(frame["file"], frame["text"], frame["added"], frame["more"], strict=True):
            try:
                json.loads(text)
                if more is not None and added != more:
                    raise ValueError("a bracket too many or too few")
            except ValueError as e:
                bad.append((file, str(e)))
        import pandas as pd

        yield pd.DataFrame(bad, columns=["file", "problem"])


def read_elements(spark: SparkSession, path: str, key: str = "verses") -> DataFrame:
    """ord, value: the objects of one JSON array a file, as JSON text.

    The array is the whole file, or the value of ``key`` in an object that is
    the file.  ``ord`` is the place in the array, counted on over several files
    in the order of their names.  Files are read three times, in splits, twice of
    these when this is called.  Text that isn't JSON, another form, and elements
    that are no objects are errors.  One task puts together what a file has
    besides the array; an element is one value in one task.
    """
    chunks = ordered_rows(spark, path, lineSep="}").withColumn("value", F.concat("value", F.lit("}")))
    given = "file string, block long, flips long, outside long, inside long, size long, top string, real long"
    changes = checkpointed(chunks.select("file", "block", "real", "value").mapInArrow(_changes, given))
    before, whole = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1), W.partitionBy("file")
    entered = changes.withColumn("inside_", (F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2).cast("int"))
    entered = entered.withColumn("change", F.when(F.col("inside_") == 1, F.col("inside")).otherwise(F.col("outside")))
    top = F.first("top", ignorenulls=True).over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    state = entered.select("file", "block", F.col("inside_").alias("inside"), F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"), F.when(top == "[", 1).otherwise(2).alias("base"), F.sum("size").over(whole).alias("size"), "real")
    state = checkpointed(state)
    if state.select("file").distinct().count() != len(spark.read.text(path).inputFiles()):
        raise ValueError("MALFORMED corpus: a file is empty")
    stated = by_split(chunks.drop("real"), state.drop("size", "real")).select("file", "block", "value", "inside", "depth", "base")
    small = checkpointed(stated.mapInArrow(_pieces(key, False), _PIECE))
    wholes = stated.mapInArrow(_pieces(key, True), _PIECE)

    # Which array a split's pieces belong to, and how many elements it has before them.
    closed = F.when(F.col("kind") == _COUNT, F.col("number")).otherwise(F.col("closes").cast("long"))
    arrays = small.groupBy("file", "block", "array").agg(F.sum(closed).alias("n"), F.max(F.when(F.col("kind") == _OPENS, F.col("text").cast("int"))).alias("sought"))
    arrays = arrays.withColumn("id", F.count("sought").over(W.partitionBy("file").orderBy("block", "array")))
    of = W.partitionBy("file", "id")
    arrays = arrays.select("file", "block", "array", "id", (F.sum("n").over(of.orderBy("block", "array")) - F.col("n")).alias("offset"), F.coalesce(F.max("sought").over(of), F.lit(0)).alias("sought"), "n")
    arrays = checkpointed(arrays)
    found = arrays.where("sought = 1").groupBy("file").agg(F.countDistinct("id").alias("arrays"), F.sum("n").alias("n"))
    files = state.groupBy("file").agg(F.max("size").alias("size"), F.max("real").alias("real")).join(found, "file", "left")
    files = checkpointed(files.select("file", "size", "real", F.coalesce("arrays", F.lit(0)).alias("arrays"), (F.sum(F.coalesce("n", F.lit(0))).over(W.orderBy("file")) - F.coalesce("n", F.lit(0))).alias("start")))  # one row a file

    # What is around the array must be JSON, without it.
    pieces = small.where(F.col("kind").isin(_AROUND, _PART, _ADDED)).join(arrays, ["file", "block", "array"], "left")
    pieces = pieces.where((F.col("kind") != _PART) | (F.coalesce("sought", F.lit(0)) == 0)).select("file", "block", "row", "piece", "kind", "text")
    others = arrays.where("sought = 0 AND n > 0")
    if not others.isEmpty():
        inner = wholes.join(others.select("file", "block", "array"), ["file", "block", "array"], "left_semi")
        pieces = pieces.unionByName(inner.select(*pieces.columns))
    around = F.array_sort(F.collect_list(F.when(F.col("kind") != _ADDED, F.struct("block", "row", "piece", "text"))))
    text = pieces.groupBy("file").agg(F.array_join(F.transform(around, lambda x: x["text"]), "").alias("text"), F.count_if(F.col("kind") == _ADDED).alias("added"))
    more = F.when(~F.col("file").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$"), F.pmod(F.col("size") - F.col("real"), F.lit(3)).cast("long"))  # a byte order mark of three bytes isn't read
    checked = text.join(files, "file").select("file", F.regexp_replace("text", "^\ufeff", "").alias("text"), "added", more.alias("more"))
    if bad := checked.mapInPandas(_problems, "file string, problem string").head(1):
        raise ValueError(f"MALFORMED corpus: {bad[0].file}: {bad[0].problem}")
    if none := files.where("arrays <> 1").head(1):
        raise ValueError(f"no {key} in the corpus: {none[0].file}" if not none[0].arrays else f"MALFORMED corpus: {key} more than once: {none[0].file}")

    mine = arrays.where("sought = 1").select("file", "block", "array", "offset").join(files.select("file", "start"), "file")
    if (n := mine.count()) <= 200_000:
        mine = F.broadcast(mine)
    placed = lambda df: df.join(mine, ["file", "block", "array"]).withColumn("place", F.col("offset") + F.col("number"))
    parts = placed(small.where(F.col("kind") == _PART)).groupBy("file", "start", "place").agg(F.array_sort(F.collect_list(F.struct("block", "row", "piece", "text"))).alias("p"), F.max("closes").alias("closes"))
    parts = checkpointed(parts.select("start", "place", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"), "closes"))
    blank = lambda c: F.trim(F.translate(c, "\t\r\n", "   "))
    if parts.where(~F.col("closes") & (blank("text") != "")).head(1):
        raise ValueError("MALFORMED corpus: the last element is no object or has no end")
    # Rows are left out where the table is read, before anything else looks at them.
    parts = checkpointed(parts.where("closes").drop("closes"))
    every = placed(wholes).select("start", "place", "text").unionByName(parts)
    # Between elements there are commas, before the first there is nothing.
    opens = F.instr("text", "{")
    good = blank(F.substring("text", F.lit(1), opens - 1)) == F.when(F.col("place") > 0, ",").otherwise("")
    text = F.when(good, F.substring("text", opens, F.length("text"))).otherwise(F.raise_error(F.lit("MALFORMED corpus: an element that is no object")).cast("string"))
    return every.select((F.col("start") + F.col("place")).alias("ord"), text.alias("value"))
