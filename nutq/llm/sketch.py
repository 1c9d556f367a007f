"""Count-min sketches built per partition, merged in slices, and quantised to levels of one or two bits.

A sketch has ``depth`` rows of ``width`` counters.  Each task sends, for every
slice of the table, the counters it touched as a compressed list; a slice is
merged by one task; the driver receives one or two bits a counter.  The table
has at most ``MOST_COUNTERS`` counters, whatever the corpus, so what is sent to
the driver and broadcast is bounded by 2 bits of each: 64 MB.  Counters never
fall below the true counts, so what they call rare is rare.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import mix

#: Counters of the largest table, all rows together.
MOST_COUNTERS = 1 << 28
LEAST_WIDTH = 1 << 16
#: Counters of one slice.
SLICE = 1 << 21
#: A task counts a counter no further than this in one list; no level may begin above it.
_CAP = 65_535


@dataclass(frozen=True)
class Shape:
    """Rows, counters of a row (a power of two), and the counts at which levels above 0 begin."""

    width: int
    depth: int = 1
    levels: tuple[int, ...] = (2,)

    @classmethod
    def of(cls, items: int, room: int, depth: int = 1, levels: tuple[int, ...] = (2,)) -> Shape:
        """With ``room`` counters in a row for each item, within bounds.

        A full table has ``load`` strange items on each counter; levels above
        the first begin beyond these, so that they still tell frequent items.
        """
        wanted = 1 << max(1, int(items * room) - 1).bit_length()
        most = 1 << (MOST_COUNTERS // depth).bit_length() - 1
        width = min(most, max(LEAST_WIDTH, wanted))
        load = items / width if items > width else 0
        return cls(width, depth, tuple(x + int(load + 4 * load**0.5) * (k > 0) for k, x in enumerate(levels)))

    @property
    def bits(self) -> int:
        return 1 if len(self.levels) == 1 else 2

    def places(self, hashes: np.ndarray) -> list[np.ndarray]:
        """Where each item's counters are, row by row."""
        out = []
        with np.errstate(over="ignore"):
            for row in range(self.depth):
                out.append(np.uint64(row * self.width) + (mix(hashes + np.uint64(row * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) & np.uint64(self.width - 1)))
        return out


class Touched:
    """Counters a task has touched, each counted up to a cap."""

    def __init__(self, shape: Shape):
        self.shape = shape
        self.parts: list[np.ndarray] = []
        self.held = 0

    def add(self, hashes: np.ndarray) -> None:
        """Count each of these once; call it with the distinct items of a document."""
        for places in self.shape.places(hashes):
            self.parts.append(places.astype(np.uint32))
            self.held += len(places)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        index, count = np.unique(np.concatenate(self.parts), return_counts=True)
        self.parts, self.held = [], 0
        count = np.minimum(count, _CAP).astype(np.uint16)
        number = index // SLICE
        cut = np.flatnonzero(np.diff(number)) + 1
        slices, packed = [], []
        for i, c in zip(np.split(index, cut), np.split(count, cut), strict=True):
            gaps = np.diff(i.astype(np.int64) % SLICE, prepend=0).astype(np.uint32)
            slices.append(int(i[0]) // SLICE)
            packed.append(zlib.compress(len(i).to_bytes(4, "little") + (gaps & 0xFF).astype(np.uint8).tobytes() + (gaps >> 8).astype(np.uint16).tobytes() + c.tobytes(), 1))
        yield pa.RecordBatch.from_arrays([pa.array(slices, pa.int32()), pa.array(packed, pa.binary())], names=["slice", "packed"])


def _merger(shape: Shape):
    def merge(key, frame):
        import pandas as pd

        total = np.zeros(SLICE, np.uint32)
        for blob in frame["packed"]:
            raw = zlib.decompress(blob)
            n = int.from_bytes(raw[:4], "little")
            gaps = np.frombuffer(raw, np.uint8, n, 4).astype(np.int64) + (np.frombuffer(raw, np.uint16, n, 4 + n).astype(np.int64) << 8)
            at = np.cumsum(gaps)
            total[at] = np.minimum(total[at] + np.frombuffer(raw, np.uint16, n, 4 + 3 * n), 1 << 30)
        level = np.digitize(total, shape.levels).astype(np.uint8)
        if shape.bits == 1:
            packed = np.packbits(level, bitorder="little")
        else:
            level = level.reshape(-1, 4)
            packed = level[:, 0] | level[:, 1] << 2 | level[:, 2] << 4 | level[:, 3] << 6
        return pd.DataFrame({"slice": [key[0]], "levels": [packed.tobytes()]})

    return merge


def build(text: DataFrame, shape: Shape, items: Callable[[pa.Array], Iterator[np.ndarray]], flush_at: int = 2_000_000) -> np.ndarray:
    """The merged sketch of ``items`` (distinct hashes, document by document) over all texts, as packed levels.

    A task holds about ``flush_at`` counters before it sends them; a slice's
    task takes the lists of all tasks one after another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        touched = Touched(shape)
        for batch in batches:
            for hashes in items(batch.column("text")):
                touched.add(hashes)
                if touched.held > flush_at:
                    yield from touched.flush()
        yield from touched.flush()

    return merge(text.select("text").mapInArrow(run, "slice int, packed binary"), shape)


def merge(sent: DataFrame, shape: Shape) -> np.ndarray:
    """The packed levels of the counters that tasks have sent, slice by slice."""
    merged = sent.groupBy("slice").applyInPandas(_merger(shape), "slice int, levels binary")
    out = np.zeros(max(1, shape.width * shape.depth * shape.bits // 8), np.uint8)
    step = SLICE * shape.bits // 8
    for row in merged.toLocalIterator():
        part = np.frombuffer(row.levels, np.uint8)
        at = row.slice * step
        out[at : at + step] = part[: len(out) - at]
    return out


def levels(shape: Shape, packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The level of each item's least counter: 0 where it is surely below the first level."""
    least: np.ndarray | None = None
    for at in shape.places(hashes):
        if shape.bits == 1:
            level = packed[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
        else:
            level = packed[(at >> np.uint64(2)).astype(np.int64)] >> ((at & np.uint64(3)) << np.uint64(1)).astype(np.uint8) & 3
        least = level if least is None else np.minimum(least, level)
    return least


def text_bytes(df: DataFrame) -> int:
    return df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
