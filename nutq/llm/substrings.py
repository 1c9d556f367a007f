"""Substring dedup: words of passages that also start in an earlier document are removed.

A window is 50 consecutive words.  Its count is overestimated by that of its
*minimizer*, the least hash among the window's runs of RUN words: equal windows
have equal minimizers.  Every partition counts the distinct minimizers of its
documents in a count-min sketch; the merged sketch, a table of counters as wide
as the corpus asks for, tells which windows may repeat.  A document without any
is done, and so is one whose whole word sequence an earlier one has.  The
windows of the others that are estimated to repeat are grouped exactly, by 128
bits of hash, so that none is lost and none is removed on an estimate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel

WINDOW = 50
RUN = 12
#: Rows of the sketch, and counters in each of them for each minimizer.
DEPTH = 2
ROOM = 64


def _minimizers(w: kernel.Words) -> tuple[np.ndarray, np.ndarray]:
    """The minimizer of every window of a chunk, and the window's first word."""
    n = len(w.hash)
    if n < WINDOW:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    runs = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    value, begins = kernel.window_hashes(w, RUN)
    runs[begins] = value
    span, least, width = WINDOW - RUN + 1, runs, 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: n - WINDOW + 1], least[span - width : span - width + n - WINDOW + 1])
    inside = np.flatnonzero(w.doc[: n - WINDOW + 1] == w.doc[WINDOW - 1 :])
    return least[inside], inside


def _kept(w: kernel.Words, doc: int, gone: np.ndarray | None) -> str:
    """sha256 of a document's kept words, joined by one space."""
    a, b = w.first[doc], w.first[doc + 1]
    start, end = w.start[a:b], w.end[a:b]
    if gone is not None:
        start, end = start[~gone], end[~gone]
    raw = w.raw.tobytes() if len(w.first) == 2 else w.raw[start[0] : end[-1]].tobytes() if len(start) else b""
    base = 0 if len(w.first) == 2 or not len(start) else int(start[0])
    return hashlib.sha256(b" ".join([raw[x - base : y - base] for x, y in zip(start.tolist(), end.tolist(), strict=True)])).hexdigest()


def _first_look(keep: list[str]):
    """A row for each document: number, words, digest, two hashes of its whole word sequence, its distinct minimizers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            column = batch.column("text")
            for first, last in kernel.chunks(column):
                n = last - first
                w = kernel.words(column.slice(first, n))
                value, begins = _minimizers(w)
                cut = np.searchsorted(begins, w.first)
                lists = [np.unique(value[a:b]) for a, b in zip(cut, cut[1:], strict=False)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                flat = np.concatenate([*lists, np.empty(0, np.uint64)]).view(np.int64)
                whole = [pa.array(kernel.text_hashes(w, k).view(np.int64)) for k in (0, 1)]
                cols = [pa.array(np.arange(at, at + n)), pa.array(np.diff(w.first).astype(np.int64)), pa.array([_kept(w, i, None) for i in range(n)], pa.string()), *whole, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                yield pa.RecordBatch.from_arrays([*map(batch.slice(first, n).column, keep), *cols], names=[*keep, "_row", "n_words", "kept_sha256", "_w1", "_w2", "_least"])
                at += n

    return run


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """h1, h2, id of the distinct windows whose minimizer may repeat."""
    for batch in batches:
        column, lists = batch.column("text"), batch.column("_maybe")
        for first, last in kernel.chunks(column):
            w = kernel.words(column.slice(first, last - first))
            one, begins = kernel.window_hashes(w, WINDOW)
            two, _ = kernel.window_hashes(w, WINDOW, 1)
            least = _minimizers(w)[0]
            cut = np.searchsorted(begins, w.first)
            out, owner = [], []
            for doc, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
                maybe = lists[first + doc].values.to_numpy(zero_copy_only=False).view(np.uint64)
                pick = np.flatnonzero(np.isin(least[a:b], maybe)) + a
                value, at = np.unique(one[pick], return_index=True)
                out.append((value, two[pick[at]]))
                owner.append(np.full(len(value), first + doc))
            h1, h2 = (np.concatenate(x).view(np.int64) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), batch.column("id").take(pa.array(np.concatenate(owner)))], names=["h1", "h2", "id"])


def _remove(keep: list[str], with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for first, last in kernel.chunks(column):
                w = kernel.words(column.slice(first, last - first))
                rows = batch.slice(first, last - first)
                lists = rows.column("_gone").to_pylist()
                n = np.diff(w.first)
                gone = np.zeros(len(w.hash), bool)
                value, begins = kernel.window_hashes(w, WINDOW)
                cut = np.searchsorted(begins, w.first)
                for doc, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
                    dead = np.array(lists[doc] or [], np.int64).view(np.uint64)
                    if a == b or not len(dead):
                        continue
                    span = slice(w.first[doc], w.first[doc + 1])
                    edge = np.zeros(n[doc] + 1, np.int64)
                    starts = np.flatnonzero(np.isin(value[a:b], dead))
                    edge[starts] += 1
                    edge[starts + WINDOW] -= 1
                    gone[span] = np.cumsum(edge[:-1]) > 0
                removed = np.add.reduceat(np.append(gone, False).astype(np.int64), w.first[:-1]) * (n > 0)
                digest = [_kept(w, i, gone[w.first[i] : w.first[i + 1]]) for i in range(last - first)]
                cols = [*map(rows.column, keep), pa.array(n.astype(np.int64)), pa.array(removed), pa.array(digest, pa.string())]
                names = [*keep, "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    cols.append(pa.array(_kept_texts(w, rows.column("text").to_pylist(), gone), pa.string()))
                    names.append("text")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _kept_texts(w: kernel.Words, texts: list[str], gone: np.ndarray) -> list[str]:
    """Texts as they were where nothing goes, else the kept words joined by one space."""
    raw, out = w.raw.tobytes(), []
    for i, text in enumerate(texts):
        a, b = w.first[i], w.first[i + 1]
        if gone[a:b].any():
            left = np.flatnonzero(~gone[a:b]) + a
            text = b" ".join([raw[x:y] for x, y in zip(w.start[left].tolist(), w.end[left].tolist(), strict=True)]).decode()
        out.append(text)
    return out


def repeated(each: DataFrame, items: int) -> DataFrame:
    """Of rows ``_row, least``, those whose ``least`` more than one row may have.

    A count-min sketch of DEPTH rows: every task's share is what Spark combines
    before the shuffle, and the merged counters are a table that is dealt by
    their numbers, so the sketch is as wide as the corpus asks for.  An item's
    count never exceeds its counters, so no repeated item is lost.
    """
    spark, width = each.sparkSession, max(1, items) * ROOM
    places = [F.pmod(F.xxhash64("least", F.lit(row)), F.lit(width)) + row * width for row in range(DEPTH)]
    counters = each.select(F.explode(F.array(*places)).alias("place")).groupBy("place").agg(F.count("*").alias("n")).where("n > 1").select("place")
    counters = kernel.write_table(spark, counters)
    for place in places:
        each = each.withColumn("place", place).join(counters, "place", "left_semi").drop("place")
    return each


def dedup(spark: SparkSession, docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """Remove each word of a window that also starts in a document with a smaller id.

    Returns ``keep``, ``n_words``, ``n_removed``, ``kept_sha256`` and, with
    ``with_text``, the kept ``text`` (unchanged where nothing goes).  Windows
    are judged on the input.  A null text has no words; a document without id
    neither removes words nor loses any; rows with one id do not remove words
    from each other; ids may be of any type that has an order; a kept column
    named like a made one gives way to it; other columns are not read; an empty
    table gives no rows.
    """
    keep = tuple(c for c in kernel.kept_columns(keep, "n_words", "n_removed", "kept_sha256") if c != "text")
    text = kernel.text_column(docs, *keep)
    schema = lambda columns: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (text.schema[c] for c in columns))
    looked = kernel.write_table(spark, text.mapInArrow(_first_look([*keep, "text"]), f"{schema([*keep, 'text'])}, _row long, n_words long, kept_sha256 string, _w1 long, _w2 long, _least array<long>"))
    # Of documents with equal words only those with the smallest id go on; the others lose all words.
    whole = looked.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= WINDOW))
    copied = whole.groupBy("_w1", "_w2").agg(F.min("doc_id").alias("_first"), F.count("*").alias("n")).where("n > 1").drop("n")
    copied = kernel.write_table(spark, copied)
    later = kernel.write_table(spark, whole.select("_row", "doc_id", "_w1", "_w2").join(copied, ["_w1", "_w2"]).where("doc_id > _first").select("_row"))
    each = whole.select("_row", F.size("_least").cast("long").alias("k"), "_least").join(later, "_row", "left_anti")
    items = each.agg(F.sum("k")).first()[0] or 0
    maybe = repeated(each.select("_row", F.explode("_least").alias("least")), items).groupBy("_row").agg(F.collect_set("least").alias("_maybe"))
    told = maybe.withColumn("_copy", F.lit(False)).unionByName(later.select("_row", F.array().cast("array<long>").alias("_maybe"), F.lit(True).alias("_copy")))
    body = F.col("text") if with_text else F.when(F.size("_maybe") > 0, F.col("text"))
    # Texts move once, to their lists of minimizers that may repeat; without ``with_text`` only theirs stay.
    dealt = looked.join(told, "_row", "left").select(*keep, "n_words", "kept_sha256", "_maybe", F.coalesce("_copy", F.lit(False)).alias("_copy"), body.alias("text"))
    dealt = kernel.write_table(spark, dealt)
    for table in (looked, copied, later):
        kernel.drop_table(spark, table)
    opened = dealt.where("size(_maybe) > 0")
    windows = opened.select(F.col("doc_id").alias("id"), "text", "_maybe").mapInArrow(_windows, f"h1 long, h2 long, id {text.schema['doc_id'].dataType.simpleString()}")
    # Minima combine before the shuffle and are a table before the join, so that a passage of very many documents is dealt out.
    first = kernel.write_table(spark, windows.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last"))
    gone = windows.join(first, ["h1", "h2"]).where("id > first").groupBy("id").agg(F.collect_set("h1").alias("_gone"))
    gone = kernel.write_table(spark, gone)
    kernel.drop_table(spark, first)
    judged = opened.join(gone.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(*keep, "text", "_gone")
    columns = [*keep, "n_words", "n_removed", "kept_sha256"] + ["text"] * with_text
    out = judged.mapInArrow(_remove(list(keep), with_text), f"{schema(keep)}, n_words long, n_removed long, kept_sha256 string" + ", text string" * with_text)
    copy, none = F.col("_copy"), F.lit(hashlib.sha256(b"").hexdigest())
    done = dealt.where("_maybe IS NULL OR size(_maybe) = 0").withColumns({"n_removed": F.when(copy, F.col("n_words")).otherwise(0), "kept_sha256": F.when(copy, none).otherwise(F.col("kept_sha256")), "text": F.when(~copy, F.col("text")).otherwise("")})
    return done.select(*columns).unionByName(out.select(*columns))
