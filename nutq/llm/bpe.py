"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task takes its documents block by block.  The words of a block that it has
not met before are laid out side by side as one array of byte tokens, and an
inverted index maps every mergeable token pair to the positions where it
starts.  Merges are then replayed in rank order over all words at once; a merge
touches only its two neighbours and files the two pairs that arise.

Pairs whose concatenation is the same token share an entry, whose positions are
taken from left to right, as the vocabulary's rank rule asks.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernel

#: Encoded words a task remembers; beyond it the memory starts anew.
WORD_MEMORY = 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks file: base64 token and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def _pack(rank: int) -> bytes:
    return rank.to_bytes(4, "little")


class MergeReplay:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {v: k for k, v in ranks.items()}
        one = [bytes([b]) for b in range(256)]
        self.single = np.array([ranks[b] for b in one], np.int64)
        self.byte_pairs = np.array([[ranks.get(a + b, -1) for b in one] for a in one], np.int64)
        self._pairs: dict[int, int] = {}

    def _rank(self, a: int, b: int) -> int:
        key = a << 32 | b
        found = self._pairs.get(key)
        if found is None:
            found = self._pairs[key] = self.ranks.get(self.token[a] + self.token[b], -1)
        return found

    def encode_words(self, found: list[bytes]) -> list[bytes]:
        """Token ids of each word, packed as little-endian unsigned 32-bit integers."""
        out = [_pack(self.ranks[w]) if w in self.ranks else None if w else b"" for w in found]
        open_ = [i for i, packed in enumerate(out) if packed is None]
        size = np.array([len(found[i]) for i in open_], np.int64)
        end = np.cumsum(size)
        raw = np.frombuffer(b"".join(found[i] for i in open_), np.uint8)
        n = len(raw)
        if not n:
            return out
        ids = self.single[raw].tolist()
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[end - 1] = -1
        before[(end - size)] = -1
        # here[p]: rank of the pair that starts at p now, or -1
        here = np.full(n, -1, np.int64)
        here[:-1] = self.byte_pairs[raw[:-1], raw[1:]]
        here[after < 0] = -1
        filed = np.argsort(here, kind="stable")
        filed = filed[here[filed] >= 0]
        present, at = np.unique(here[filed], return_index=True)
        index = {r: x.tolist() for r, x in zip(present.tolist(), np.split(filed, at[1:]), strict=True)}
        after, before, here = after.tolist(), before.tolist(), here.tolist()
        known, rank = self._pairs.get, self._rank
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            r = heapq.heappop(heap)
            positions = index.pop(r, None)
            if positions is None:
                continue
            positions.sort()
            for k, p in enumerate(positions):
                if here[p] != r:
                    continue  # a neighbour changed since the pair was filed
                q = after[p]
                ids[p], ids[q], here[q] = r, -1, -1
                nxt = after[p] = after[q]
                prev = before[p]
                least = r
                if nxt >= 0:
                    before[nxt] = p
                    new = known(r << 32 | ids[nxt])
                    if new is None:
                        new = rank(r, ids[nxt])
                    here[p] = new
                    if new >= 0:
                        if new in index:
                            index[new].append(p)
                        else:
                            index[new] = [p]
                            heapq.heappush(heap, new)
                        if new < least:
                            least = new
                else:
                    here[p] = -1
                if prev >= 0:
                    new = known(ids[prev] << 32 | r)
                    if new is None:
                        new = rank(ids[prev], r)
                    here[prev] = new
                    if new >= 0:
                        if new in index:
                            index[new].append(prev)
                        else:
                            index[new] = [prev]
                            heapq.heappush(heap, new)
                        if new < least:
                            least = new
                if least < r and k + 1 < len(positions):  # a smaller rank arose: it goes first
                    index[r] = positions[k + 1 :]
                    heapq.heappush(heap, r)
                    break
        left = np.array(ids, np.int64)
        live = left >= 0
        packed = left[live].astype("<u4").tobytes()
        stop = (np.cumsum(live)[end - 1] * 4).tolist()
        for i, a, b in zip(open_, [0, *stop[:-1]], stop, strict=True):
            out[i] = packed[a:b]
        return out  # type: ignore[return-value]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def _tokenize(path: str, pattern: str, keep: list[str], with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        coder = MergeReplay(load_ranks(path))
        split = regex.compile(pattern).findall
        memory: dict[str, bytes] = {}
        for batch in batches:
            column = batch.column("text")
            for first, last in kernel.chunks(column):
                block = [split(x or "") for x in column.slice(first, last - first).to_pylist()]
                if len(memory) > WORD_MEMORY:
                    memory.clear()
                new = [w for w in set().union(*block) if w not in memory]
                memory.update(zip(new, coder.encode_words([w.encode() for w in new]), strict=True))
                rows = batch.slice(first, last - first)
                packed = [b"".join(map(memory.__getitem__, found)) for found in block]
                decoded = [coder.decode(np.frombuffer(x, "<u4").tolist()) for x in packed]
                cols = [rows.column(c) for c in keep]
                cols += [
                    pa.array([len(x) // 4 for x in packed], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in packed], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
                ]
                names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    flat = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
                    at = np.concatenate([[0], np.cumsum([len(x) // 4 for x in packed])]).astype(np.int32)
                    cols += [pa.ListArray.from_arrays(pa.array(at), pa.array(flat)), pa.array(decoded, pa.binary())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """Encode every whole text, decode the ids, and return a row per document.

    Columns: ``keep``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; with
    ``with_ids`` also ``ids`` and the decoded bytes.  A null text counts as
    empty: no tokens and the digest of nothing.  Repeated rows give repeated
    rows, other columns are not read, and an empty table gives an empty result.
    The work is row-local: no shuffle, and a lost task is simply run again.
    """
    keep = kernel.without_made(keep, "n_tokens", "ids_sha256", "decoded_sha256", *["ids", "decoded"] * with_ids)
    kept = [docs.schema[c] for c in keep]
    text = kernel.text_column(docs, *keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["n_tokens long, ids_sha256 string, decoded_sha256 string"] + ["ids array<int>, decoded binary"] * with_ids)
    return text.mapInArrow(_tokenize(ranks_path, pattern, list(keep), with_ids), schema)
