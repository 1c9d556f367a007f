"""Vectorised word kernels that run inside tasks, and small helpers around them.

Words are maximal runs of bytes outside space and ``\\t \\n \\v \\f \\r``.  Every
function works on a *chunk*: consecutive whole texts of one Arrow batch, of
about ``CHUNK_BYTES`` bytes, so a task's memory does not depend on its input.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
#: Rows of the batches that Spark sends to a task's Python, where the session has its default.
BATCH_ROWS = 1000
_BYTE_MULTIPLIER = 0x9E3779B97F4A7C15
_WORD_MULTIPLIERS = (0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
#: Fixed values of the 64-bit hash that Spark's ``xxhash64`` computes.
_XXHASH_PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def xxhash64(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64(a, b)`` of two columns of longs, given and returned as unsigned ones."""
    one, two, three, four, five = (np.uint64(x) for x in _XXHASH_PRIMES)
    out, part, high = np.full(len(a), 42, np.uint64), np.empty(len(a), np.uint64), np.empty(len(a), np.uint64)

    def turn(x: np.ndarray, k: int) -> None:
        np.right_shift(x, np.uint64(64 - k), out=high)
        np.left_shift(x, np.uint64(k), out=x)
        np.bitwise_or(x, high, out=x)

    def fold(k: int) -> None:
        np.right_shift(out, np.uint64(k), out=high)
        np.bitwise_xor(out, high, out=out)

    with np.errstate(over="ignore"):
        for column in (a, b):
            np.multiply(column, two, out=part)
            turn(part, 31)
            part *= one
            out += five + np.uint64(8)
            out ^= part
            turn(out, 27)
            out *= one
            out += four
            fold(33)
            out *= two
            fold(29)
            out *= three
            fold(32)
    return out


#: Powers that chunks of the usual size need, by base; they are the same for each chunk.
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64; not to be written to."""
    most = CHUNK_BYTES + 2
    if n <= most and base in _powers:
        return _powers[base][:n]
    full = np.full(max(n, most), base, np.uint64)
    full[:1] = 1
    full = np.multiply.accumulate(full)
    if len(full) == most:
        full.flags.writeable = False
        _powers[base] = full
    return full[:n]


def ascending(keys: np.ndarray) -> np.ndarray:
    """The stable order of unsigned 64-bit hashes: their first bits are sorted together with the places, many times faster than an argsort."""
    mask = np.uint64((1 << max(1, len(keys) - 1).bit_length()) - 1)
    order = np.sort(keys & ~mask | np.arange(len(keys), dtype=np.uint64)) & mask
    order = order.astype(np.int64)
    found, done = keys[order], 0
    for i in np.flatnonzero(found[1:] < found[:-1]):  # different hashes with the same first bits
        if i >= done:
            begin, done = (int(np.searchsorted(found & ~mask, found[i] & ~mask, side=side)) for side in ("left", "right"))
            order[begin:done] = order[begin:done][np.argsort(found[begin:done], kind="stable")]
    return order


def starts(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.empty(0, np.int64)


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column, nulls as empty, and n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer text is a chunk of its own."""
    if not len(column):
        return
    _, at = text_buffers(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(at, at[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last
        first = last


@dataclass
class Words:
    """The words of a chunk, in order."""

    raw: np.ndarray  # bytes of the chunk
    start: np.ndarray  # byte offset of each word
    end: np.ndarray
    doc: np.ndarray  # index of the word's text in the chunk
    first: np.ndarray  # n_texts + 1 offsets into the words
    hash: np.ndarray  # uint64, equal for equal words


def words(column: pa.Array, lower: bool = False) -> Words:
    """Words of a chunk's texts; ``lower`` folds A-Z only."""
    raw, at = text_buffers(column)
    n = len(raw)
    if lower:
        raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    is_start = inside[1:] & (~inside[:-1] | edge)
    is_end = inside[:-1] & (~inside[1:] | edge)
    start = np.flatnonzero(is_start[:n]) if n else np.empty(0, np.int64)
    end = np.flatnonzero(is_end)
    first = np.searchsorted(start, at)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    with np.errstate(over="ignore"):
        table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_WORD_MULTIPLIERS[1]))
        sums = np.zeros(n + 1, np.uint64)
        values = table[raw]
        values *= powers(_BYTE_MULTIPLIER, n)
        np.cumsum(values, out=sums[1:])
        value = (sums[end] - sums[start]) * powers(inverse(_BYTE_MULTIPLIER), n + 1)[start]
        value = mix(value ^ (end - start).astype(np.uint64))
    return Words(raw, start, end, doc, first, value)


def window_hashes(w: Words, k: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of k words inside one text, and the index of its first word."""
    n = len(w.hash)
    if n < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    base = _WORD_MULTIPLIERS[which]
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(w.hash * powers(base, n), out=sums[1:])
        value = mix((sums[k:] - sums[:-k]) * powers(inverse(base), n + 1)[: n - k + 1])
    begins = np.flatnonzero(w.doc[: n - k + 1] == w.doc[k - 1 :])
    return value[begins], begins


def text_hashes(w: Words, which: int = 0) -> np.ndarray:
    """Hash of the whole word sequence of every text."""
    n, base, a, b = len(w.hash), _WORD_MULTIPLIERS[which], w.first[:-1], w.first[1:]
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(w.hash * powers(base, n), out=sums[1:])
        return mix((sums[b] - sums[a]) * powers(inverse(base), n + 1)[a] + (b - a).astype(np.uint64))


def materialize(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Cut lineage through the folder all executors share.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; only
    where that is unset (tests, a laptop) a folder under the warehouse is used.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(where or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
    out = df.checkpoint(eager=True)
    release(spark)
    return out


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    It does so when the driver collects garbage, which may be half an hour
    later; a job of many steps would keep the files of all of them until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remainder(column: str, divisor: int):
    """crc32 of a column as text, modulo; a null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def short_batches(spark: SparkSession) -> None:
    """Whole texts are long, so batches of them are short."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, BATCH_ROWS)


@contextmanager
def long_batches(spark: SparkSession) -> Iterator[None]:
    """Tables of numbers have short rows, so batches of them are long; for jobs that read no texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if before == str(BATCH_ROWS):
        spark.conf.set(name, 10_000)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_column(df: DataFrame, *keep: str) -> DataFrame:
    """Only the columns named and ``text``, nulls as empty, in short batches."""
    short_batches(df.sparkSession)
    return df.select(*[c for c in keep if c != "text"], F.coalesce(F.col("text"), F.lit("")).alias("text"))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Folders of the tables that operators wrote and that nobody has deleted yet.
_tables: list[str] = []
#: Of each scope that is open, the folders of the tables written in it.
_scopes: list[list[str]] = []


@contextmanager
def scope() -> Iterator[list[str]]:
    """The folders of the tables that are written while it is open, so that their owner can delete them and no others."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes.pop()


def without_made(keep: tuple[str, ...], *made: str) -> tuple[str, ...]:
    """The columns to carry along, each once; one whose name the operator gives to a column of its own gives way to it."""
    return tuple(c for c in dict.fromkeys(keep) if c not in made)


def kept_columns(keep: tuple[str, ...], *made: str) -> tuple[str, ...]:
    """The columns to carry along, and the id; one whose name the operator gives to a column of its own gives way to it."""
    return without_made((*keep, "doc_id"), *made)


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"


def write_table(spark: SparkSession, df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write a frame as Parquet in the shared folder, and read it back: lineage is cut, columns are read singly."""
    path = f"{shared_root(spark)}/nutq-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    for made in (_tables, *_scopes):
        made.append(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    _tables.remove(path)


def drop_table(spark: SparkSession, df: DataFrame) -> None:
    """Delete a frame's folder that ``write_table`` made; nothing may read it any more."""
    for path in [p for p in _tables if any(p in file for file in df.inputFiles()[:1])]:
        _delete(spark, path)


def sweep(spark: SparkSession, made: list[str], docs: DataFrame) -> None:
    """Delete the tables of a scope but those that ``docs`` reads.

    For a chain of stages whose results are written one by one: what a stage
    has left is of no use once its result is a table.
    """
    read = docs.inputFiles()
    for path in [p for p in made if p in _tables and not any(p in file for file in read)]:
        _delete(spark, path)
    release(spark)
