"""Progressive JPEG for media columns, vectorised over all images of a chunk.

A payload is stored losslessly as quantised coefficients (the format's unit):
64 bytes are one 8x8 block in zigzag order, all quantiser steps are 1.  The
luma plane takes the first two thirds of the blocks, the chroma planes, of half
its resolution, the rest.  Scans: DC without its lowest bit, AC 1-5 and 6-63 of
each component without theirs (spectral selection), then the lowest bits
(successive approximation).  A restart marker follows every unit, so a decoder
may read all units of all images side by side: one numpy step takes the next
symbol of every unit.

The decoder accumulates scans into coefficient arrays, applies the inverse
transform, upsamples chroma and returns full-resolution RGB tensors.  It reads
three-component images with any scan script, tables and restart interval; sides
must be whole multiples of the coded unit.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import kernel

BLOCK = 64
#: Coded units in a row of the image.
COLUMNS = 64
#: Payload bytes that are coded side by side.
CHUNK_BYTES = 1 << 20

ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))
#: The one-dimensional cosine basis.
_BASIS = np.array([[np.sqrt((1 if u == 0 else 2) / 8) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)])

#: What each coefficient, in zigzag order, adds to the 64 samples of its block.
_INVERSE = np.kron(_BASIS, _BASIS)[ZIGZAG]

#: Sampling factors of the components the encoder writes.
SAMPLING = ((2, 2), (1, 1), (1, 1))
EOB, ZRL = 0x00, 0xF0
#: (components, first and last coefficient, high and low bit) of each scan.
SCANS = [((0, 1, 2), 0, 0, 0, 1)] + [((c,), a, b, 0, 1) for c in range(3) for a, b in ((1, 5), (6, 63))] + [((0, 1, 2), 0, 0, 1, 0)] + [((c,), 1, 63, 1, 0) for c in range(3)]


def _table(lengths: dict[int, list[int]]) -> bytes:
    """A Huffman table as files hold it: counts of codes of 1 to 16 bits, then the symbols."""
    return bytes(len(lengths.get(n, [])) for n in range(1, 17)) + bytes(s for n in sorted(lengths) for s in lengths[n])


# Letters have six bits above the lowest, spaces and digits five, other scripts seven; the rest is rare.
DC_TABLE = _table({4: list(range(12))})
AC_TABLE = _table({1: [0x06], 2: [0x05], 3: [0x07], 6: [0x04, 0x03, 0x02, 0x01, EOB, ZRL], 12: [0x08] + [r << 4 | s for r in range(1, 16) for s in range(1, 9)]})


_known: dict[tuple, object] = {}


def _once(key: tuple, make):
    """What ``make`` returns, kept for the task."""
    if key not in _known:
        if len(_known) > 500:
            _known.clear()
        _known[key] = make()
    return _known[key]


def _codes(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code and length of each symbol."""
    return _once(("codes", table), lambda: _make_codes(table))


def _make_codes(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    code, length = np.zeros(256, np.uint64), np.zeros(256, np.int64)
    value, at = 0, 0
    for n, count in enumerate(table[:16], 1):
        for symbol in table[16 + at : 16 + at + count]:
            code[symbol], length[symbol] = value, n
            value += 1
        at += count
        value <<= 1
    return code, length


def _lookup(table: bytes) -> np.ndarray:
    """For the next 16 bits: length of the code << 8 | symbol."""
    return _once(("lookup", table), lambda: _make_lookup(table))


def _make_lookup(table: bytes) -> np.ndarray:
    out = np.zeros(1 << 16, np.int32)
    code, length = _codes(table)
    for symbol in table[16:]:
        n = int(length[symbol])
        first = int(code[symbol]) << (16 - n)
        out[first : first + (1 << (16 - n))] = n << 8 | symbol
    return out


# --- encoding -----------------------------------------------------------------


def _pack(unit: np.ndarray, value: np.ndarray, bits: np.ndarray, n_units: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all units, each padded with ones, and each unit's length; tokens come unit by unit."""
    per_unit = np.bincount(unit, bits, n_units).astype(np.int64)
    size = (per_unit + 7) >> 3
    start = np.cumsum(size) - size
    at = start[unit] * 8 + (np.cumsum(bits) - bits) - (np.cumsum(per_unit) - per_unit)[unit]
    out = np.zeros(int(size.sum()) + 8, np.uint8)
    shifted = value << (64 - (at & 7) - bits).astype(np.uint64)
    byte, reach = at >> 3, (at & 7) + bits
    for j in range(int(reach.max(initial=0) + 7) >> 3):
        far = slice(None) if j == 0 else np.flatnonzero(reach > 8 * j)
        np.add.at(out, byte[far] + j, (shifted[far] >> np.uint64(56 - 8 * j)).astype(np.uint8))
    odd = np.flatnonzero(per_unit & 7)
    out[start[odd] + size[odd] - 1] |= ((1 << (8 - (per_unit[odd] & 7))) - 1).astype(np.uint8)
    return out[: int(size.sum())], size


def _frames(data: np.ndarray, size: np.ndarray, units: np.ndarray) -> list[bytes]:
    """Each image's scan: units stuffed and parted by restart markers."""
    stuffed = data == 0xFF
    ends = np.cumsum(size)
    number = np.arange(len(size)) - np.repeat(np.cumsum(units) - units, units)
    last = np.zeros(len(size), bool)
    last[np.cumsum(units) - 1] = True
    marks = np.where(last, 0, 2)
    of = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(data)) + np.cumsum(stuffed) - stuffed + (np.cumsum(marks) - marks)[of]
    unit_bytes = size + np.add.reduceat(np.append(stuffed, False).astype(np.int64), ends - size) * (size > 0) + marks
    out = np.zeros(int(unit_bytes.sum()), np.uint8)
    out[at] = data
    tail = np.cumsum(unit_bytes)[~last]
    out[tail - 2], out[tail - 1] = 0xFF, 0xD0 + number[~last] % 8
    cut = np.cumsum(np.add.reduceat(unit_bytes, np.cumsum(units) - units))
    raw = out.tobytes()
    return [raw[a:b] for a, b in zip([0, *cut[:-1].tolist()], cut.tolist(), strict=True)]


_SIZE = np.array([int(x).bit_length() for x in range(512)])


def _ac_first(coef: np.ndarray, a: int, b: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    code, length = _codes(AC_TABLE)
    band = coef[:, a : b + 1] >> low
    row, col = np.nonzero(band)
    value = band[row, col].astype(np.uint64)
    before = np.full(len(col), -1)
    before[1:] = np.where(row[1:] == row[:-1], col[:-1], -1)
    run = col - before - 1
    size = _SIZE[value.astype(np.int64)]
    symbol = (run & 15) << 4 | size
    bits = length[symbol] + size
    token = code[symbol] << size.astype(np.uint64) | value
    zrl = np.flatnonzero(run > 15)
    for k in range(1, 4):
        more = zrl[run[zrl] >= 16 * k]
        token[more] |= code[ZRL] << bits[more].astype(np.uint64)
        bits[more] += length[ZRL]
    count = np.bincount(row, minlength=len(coef))
    last = np.cumsum(count) - 1
    open_ = np.flatnonzero((count == 0) | (np.append(col, 0)[np.maximum(last, 0)] < b - a))
    place = np.cumsum(count)[open_]
    return _pack(np.insert(row, place, open_), np.insert(token, place, code[EOB]), np.insert(bits, place, length[EOB]), len(coef))


def _ac_refine(coef: np.ndarray, a: int, b: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    code, length = _codes(AC_TABLE)
    band = coef[:, a : b + 1]
    old, new = band >> low + 1 != 0, band >> low == 1
    plain = ~new.any(axis=1)
    # Most units: an end of block, then a correction bit for each coefficient that is not zero already.
    n_bits = np.where(plain, length[EOB] + old.sum(axis=1), 0)
    slow = {}
    for i in np.flatnonzero(~plain).tolist():
        slow[i] = _refine_bits(band[i].tolist(), low, code, length)
        n_bits[i] = len(slow[i])
    size = (n_bits + 7) >> 3
    start = (np.cumsum(size) - size) * 8
    bits = np.ones(int(size.sum()) * 8, np.uint8)
    for j in range(int(length[EOB])):
        bits[start[plain] + j] = int(code[EOB]) >> (int(length[EOB]) - 1 - j) & 1
    row, col = np.nonzero(old & plain[:, None])
    count = np.bincount(row, minlength=len(coef))
    rank = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    bits[start[row] + length[EOB] + rank] = band[row, col] >> low & 1
    for i, x in slow.items():
        bits[start[i] : start[i] + len(x)] = x
    return np.packbits(bits), size


def _refine_bits(band: list[int], low: int, code: np.ndarray, length: np.ndarray) -> list[int]:
    """Bits of a unit in which coefficients become nonzero."""
    spell = lambda s: [int(code[s]) >> i & 1 for i in range(int(length[s]) - 1, -1, -1)]
    out: list[int] = []
    waiting: list[int] = []
    run, last_new = 0, max(k for k, v in enumerate(band) if v >> low == 1)
    for k, v in enumerate(band):
        v >>= low
        if v == 0:
            run += 1
            continue
        while run > 15 and k <= last_new:
            out += spell(ZRL) + waiting
            waiting, run = [], run - 16
        if v > 1:
            waiting.append(v & 1)
        else:
            out += [*spell(run << 4 | 1), 1, *waiting]
            waiting, run = [], 0
    return out + (spell(EOB) + waiting if run or waiting else [])


def _dc(dc: np.ndarray, first: bool, low: int) -> tuple[np.ndarray, np.ndarray]:
    """dc: units x blocks of a unit, four of luma and two of chroma."""
    n, k = dc.shape
    unit = np.repeat(np.arange(n), k)
    if not first:
        return _pack(unit, (dc.ravel() >> low & 1).astype(np.uint64), np.ones(n * k, np.int64), n)
    code, length = _codes(DC_TABLE)
    diff = dc >> low
    diff[:, 1:4] -= dc[:, :3] >> low
    diff = diff.ravel()
    size = _SIZE[np.abs(diff)]
    value = np.where(diff < 0, diff + (1 << size) - 1, diff).astype(np.uint64)
    return _pack(unit, code[size] << size.astype(np.uint64) | value, length[size] + size, n)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _head(rows: int, cols: int, blocks: int) -> bytes:
    frame = struct.pack(">BHHB", 8, rows * 16, cols * 16, 3) + b"".join(bytes([c + 1, h << 4 | v, 0]) for c, (h, v) in enumerate(SAMPLING))
    tables = b"\x00" + DC_TABLE + b"\x10" + AC_TABLE
    return b"\xff\xd8" + _segment(0xFE, b"blocks %d" % blocks) + _segment(0xDB, b"\x00" + b"\x01" * 64) + _segment(0xC2, frame) + _segment(0xC4, tables) + _segment(0xDD, struct.pack(">H", 1))


def geometry(blocks: int) -> tuple[int, int]:
    """Rows and columns of coded units for so many blocks."""
    units = max(1, -(-blocks // 6))
    rows = -(-units // max(COLUMNS, -(-units // 4000)))
    return rows, -(-units // rows)


def unit_blocks(rows: int, cols: int, sampling: tuple[tuple[int, int], ...] = SAMPLING) -> list[tuple[int, np.ndarray]]:
    """(component, number of its block) in each coded unit, block by block of the unit."""
    return _once(("order", rows, cols, sampling), lambda: _make_unit_blocks(rows, cols, sampling))


def _make_unit_blocks(rows: int, cols: int, sampling: tuple[tuple[int, int], ...]) -> list[tuple[int, np.ndarray]]:
    r, c = np.divmod(np.arange(rows * cols), cols)
    return [(k, (r * v + y) * (cols * h) + c * h + x) for k, (h, v) in enumerate(sampling) for y in range(v) for x in range(h)]


def encode(payloads: list[bytes]) -> list[bytes]:
    """An image for each payload, whose length is a positive multiple of 64."""
    shapes = [geometry(len(p) // BLOCK) for p in payloads]
    planes: list[list[np.ndarray]] = [[], [], []]
    units = []
    for p, (rows, cols) in zip(payloads, shapes, strict=True):
        n = rows * cols
        flat = np.zeros((6 * n, BLOCK), np.int32)
        flat[: len(p) // BLOCK] = np.frombuffer(p, np.uint8).reshape(-1, BLOCK)
        for c, part in enumerate(np.split(flat, (4 * n, 5 * n))):
            planes[c].append(part)
        units.append(n)
    coef = [np.concatenate(p) for p in planes]
    count = np.array(units)
    base = np.cumsum(count) - count
    order = [unit_blocks(r, c) for r, c in shapes]
    dc = np.stack([np.concatenate([coef[k][b * (4 if k == 0 else 1) + o[j][1], 0] for b, o in zip(base.tolist(), order, strict=True)]) for j, (k, _) in enumerate(order[0])], axis=1)
    out = [[_head(r, c, len(p) // BLOCK)] for p, (r, c) in zip(payloads, shapes, strict=True)]
    for comps, a, b, high, low in SCANS:
        if a == 0:
            data, size = _dc(dc, high == 0, low)
            per_image = count
        else:
            data, size = (_ac_first if high == 0 else _ac_refine)(coef[comps[0]], a, b, low)
            per_image = count * (4 if comps[0] == 0 else 1)
        head = _segment(0xDA, bytes([len(comps)]) + b"".join(bytes([c + 1, 0]) for c in comps) + bytes([a, b, high << 4 | low]))
        for image, frame in zip(out, _frames(data, size, per_image), strict=True):
            image += [head, frame]
    return [b"".join([*image, b"\xff\xd9"]) for image in out]


# --- decoding -----------------------------------------------------------------

_MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")
_RESTART = re.compile(rb"\xff[\xd0-\xd7]")
_PAD = b"\x00" * 4


def parse(data: bytes) -> dict:
    """Frame, tables and scans of a file; scans hold their units' bytes."""
    image: dict = {"quant": {}, "tables": {}, "restart": 0, "scans": [], "comment": b""}
    at = 2
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    while data[at + 1] != 0xD9:
        marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide, name = body[0] >> 4, body[0] & 15
                image["quant"][name] = struct.unpack_from(f">64{'H' if wide else 'B'}", body, 1)
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                image["tables"][body[0]] = body[1 : 17 + n]
                body = body[17 + n :]
        elif marker == 0xC2:
            _, image["height"], image["width"], n = struct.unpack_from(">BHHB", body)
            image["components"] = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)]
        elif 0xC0 <= marker <= 0xCF and marker != 0xC8:
            raise ValueError("not a progressive Huffman-coded JPEG file")
        elif marker == 0xDD:
            image["restart"] = struct.unpack(">H", body)[0]
        elif marker == 0xFE:
            image["comment"] = body
        elif marker == 0xDA:
            n = body[0]
            a, b, bits = body[1 + 2 * n : 4 + 2 * n]
            names = [x[0] for x in image["components"]]
            comps = tuple(names.index(body[1 + 2 * k]) for k in range(n))
            used = tuple((t >> 4, t & 15) for t in (body[2 + 2 * k] for k in range(n)))
            end = _MARKER.search(data, at).start()
            units = [x.replace(b"\xff\x00", b"\xff") for x in _RESTART.split(data[at:end])]
            tables = tuple(image["tables"].get(d if a == 0 else 16 | c, b"") for d, c in used)
            image["scans"].append(((comps, a, b, bits >> 4, bits & 15, tables, image["restart"]), units))
            at = end
    return image


class _Bits:
    """Readers over units that lie side by side in one buffer."""

    def __init__(self, units: list[bytes]):
        raw = np.frombuffer(_PAD.join(units) + _PAD, np.uint8).astype(np.int32)
        size = np.fromiter(map(len, units), np.int64, len(units)) + len(_PAD)
        self.at = ((np.cumsum(size) - size) * 8).astype(np.int64)
        self.window = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
        self.last = len(self.window) - 1

    def peek(self, at: np.ndarray, n) -> np.ndarray:
        """The n bits at each place; n up to 16."""
        return self.window[np.minimum(at >> 3, self.last)] >> (24 - (at & 7) - n) & ((1 << n) - 1)


def _extend(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(value < (1 << np.maximum(size - 1, 0)), value - (1 << size) + 1, value) * (size > 0)


def _read_dc(bits: _Bits, coef: list[np.ndarray], blocks: list[tuple[int, np.ndarray]], unit: np.ndarray, live: np.ndarray, pred: np.ndarray, lookup: list[np.ndarray], high: int, low: int) -> None:
    """One coded unit of each reader: ``unit`` is its number, ``live`` the readers that have one more."""
    at = bits.at[live]
    for j, (k, number) in enumerate(blocks):
        where = number[unit]
        if high:
            coef[k][where, 0] |= bits.peek(at, 1) << low
            at = at + 1
        else:
            found = lookup[j][bits.peek(at, 16)]
            at, size = at + (found >> 8), found & 255
            pred[live, k] += _extend(bits.peek(at, size), size)
            at = at + size
            coef[k][where, 0] = pred[live, k] << low
    bits.at[live] = at


def _read_ac_first(bits: _Bits, coef: np.ndarray, block: np.ndarray, live: np.ndarray, eobrun: np.ndarray, lookup: np.ndarray, a: int, b: int, low: int) -> None:
    ended = eobrun[live] > 0
    eobrun[live[ended]] -= 1
    live, block = live[~ended], block[~ended]
    at, k = bits.at[live], np.full(len(live), a)
    while len(live):
        found = lookup[bits.peek(at, 16)]
        at = at + (found >> 8)
        size, run = found & 15, found >> 4 & 15
        k = k + run
        value = _extend(bits.peek(at, size), size) << low
        some = size > 0
        if some.all():
            coef[block, k] = value
            at, k = at + size, k + 1
            done = k > b
        else:
            coef[block[some], k[some]] = value[some]
            end = ~some & (run < 15)
            eobrun[live[end]] = (1 << run[end]) - 1 + bits.peek(at[end], run[end])
            at, k = at + np.where(end, run, size), k + 1
            done = end | (k > b)
        if done.any():
            bits.at[live[done]] = at[done]
            go = ~done
            live, block, at, k = live[go], block[go], at[go], k[go]


def _correct(bits: _Bits, coef: np.ndarray, block: np.ndarray, at: np.ndarray, start: np.ndarray, stop: np.ndarray, low: int) -> np.ndarray:
    """Read a correction bit for every coefficient from start to stop that is not zero; the new places."""
    column = np.arange(64)
    mine = coef[block]
    old = (mine != 0) & (column >= start[:, None]) & (column < stop[:, None])
    rank = np.cumsum(old, axis=1)
    row, col = np.nonzero(old)
    bit = bits.peek(at[row] + rank[row, col] - 1, 1)
    coef[block[row], col] += np.sign(mine[row, col]) * (bit << low)
    return at + rank[:, -1]


def _read_ac_refine(bits: _Bits, coef: np.ndarray, block: np.ndarray, live: np.ndarray, eobrun: np.ndarray, lookup: np.ndarray, a: int, b: int, low: int) -> None:
    k, at = np.full(len(live), a), bits.at[live]
    ready = eobrun[live] > 0  # these only have corrections left
    todo = np.flatnonzero(~ready)
    while len(todo):
        found = lookup[bits.peek(at[todo], 16)]
        at[todo] += found >> 8
        size, run = found & 15, found >> 4 & 15
        end = (size == 0) & (run < 15)
        stop = todo[end]
        eobrun[live[stop]] = (1 << run[end]) + bits.peek(at[stop], run[end])
        at[stop] += run[end]
        todo, size, run = todo[~end], size[~end], run[~end]
        sign = bits.peek(at[todo], 1) * 2 - 1
        at[todo] += size > 0
        # The place after `run` more coefficients that are still zero.
        zero = (coef[block[todo]] == 0) & (np.arange(64) >= k[todo, None]) & (np.arange(64) <= b)
        reach = np.cumsum(zero, axis=1) > run[:, None]
        place = np.where(reach.any(axis=1), reach.argmax(axis=1), b + 1)
        at[todo] = _correct(bits, coef, block[todo], at[todo], k[todo], place, low)
        new = size > 0
        coef[block[todo[new]], place[new]] = sign[new] << low
        k[todo] = place + 1
        todo = todo[k[todo] <= b]
    rest = np.flatnonzero(eobrun[live] > 0)
    at[rest] = _correct(bits, coef, block[rest], at[rest], k[rest], np.full(len(rest), b + 1), low)
    eobrun[live[rest]] -= 1
    bits.at[live] = at


def coefficients(images: list[dict]) -> list[list[np.ndarray]]:
    """Each image's coefficient arrays, component by component, blocks x 64 in zigzag order."""
    out: list[list[np.ndarray] | None] = [None] * len(images)
    alike: dict[tuple, list[int]] = {}
    for i, image in enumerate(images):
        alike.setdefault((tuple(image["components"]), *[s for s, _ in image["scans"]]), []).append(i)
    for group in alike.values():
        for i, planes in zip(group, _read_group([images[i] for i in group]), strict=True):
            out[i] = planes
    return out  # type: ignore[return-value]


def _read_group(images: list[dict]) -> list[list[np.ndarray]]:
    """Images of one scan script, scan by scan, all units of all images side by side."""
    sampling = tuple((h, v) for _, h, v, _ in images[0]["components"])
    wide, tall = max(h for h, _ in sampling), max(v for _, v in sampling)
    if any(x["width"] % (8 * wide) or x["height"] % (8 * tall) for x in images):
        raise ValueError("sides must be whole multiples of the coded unit")
    shape = [(x["height"] // (8 * tall), x["width"] // (8 * wide)) for x in images]
    units = np.array([r * c for r, c in shape])
    base = np.cumsum(units) - units
    coef = [np.zeros((int(units.sum()) * h * v, 64), np.int32) for h, v in sampling]
    for s, ((comps, a, b, high, low, tables, restart), _) in enumerate(images[0]["scans"]):
        parts = [x["scans"][s][1] for x in images]
        bits = _Bits([u for p in parts for u in p])
        lookup = [_lookup(t) if t else np.zeros(0, np.int32) for t in tables]
        several = len(comps) > 1
        each = 1 if several else sampling[comps[0]][0] * sampling[comps[0]][1]
        total = units * each
        every = np.array([restart or n for n in total.tolist()])
        readers = np.array([len(p) for p in parts])
        of = np.repeat(np.arange(len(images)), readers)
        number = np.arange(len(of)) - np.repeat(np.cumsum(readers) - readers, readers)
        start = base[of] * each + number * every[of]
        stop = np.minimum(start + every[of], (base[of] + units[of]) * each)
        eobrun = np.zeros(len(of), np.int64)
        pred = np.zeros((len(of), len(sampling)), np.int64)
        if several:
            orders = [unit_blocks(r, c, sampling) for r, c in shape]
            place = [(k, np.concatenate([o[j][1] + f * sampling[k][0] * sampling[k][1] for o, f in zip(orders, base.tolist(), strict=True)])) for j, (k, _) in enumerate(orders[0]) if k in comps]
            lookup = [lookup[comps.index(k)] for k, _ in place]
        for step in range(int((stop - start).max(initial=0))):
            live = np.flatnonzero(start + step < stop)
            block = start[live] + step
            if a == 0 and several:
                _read_dc(bits, coef, place, block, live, pred, lookup, high, low)
            elif a == 0:
                _read_dc(bits, coef, [(comps[0], np.arange(len(coef[comps[0]])))], block, live, pred, lookup, high, low)
            else:
                (_read_ac_refine if high else _read_ac_first)(bits, coef[comps[0]], block, live, eobrun, lookup[0], a, b, low)
    cut = [[(x * h * v, (x + n) * h * v) for h, v in sampling] for x, n in zip(base.tolist(), units.tolist(), strict=True)]
    return [[coef[k][p:q] for k, (p, q) in enumerate(c)] for c in cut]


def samples(coef: np.ndarray, quant: tuple[int, ...]) -> np.ndarray:
    """The inverse transform of a component's blocks: blocks x 8 x 8 samples, 0 to 255."""
    block = coef.astype(np.float64) @ (_INVERSE * np.array(quant)[:, None])
    # Ties go up, whatever the last bits of the sums.
    return np.clip(np.floor(block + (128.5 + 1e-6)), 0, 255).astype(np.float32).reshape(-1, 8, 8)


def rgb(image: dict, planes: list[np.ndarray]) -> list[np.ndarray]:
    """The full-resolution red, green and blue planes of a three-component image."""
    wide, tall = max(c[1] for c in image["components"]), max(c[2] for c in image["components"])
    up = [lambda p, c=c: p if (c[1], c[2]) == (wide, tall) else p.repeat(tall // c[2], axis=0).repeat(wide // c[1], axis=1) for c in image["components"]]
    y, cb, cr = up[0](planes[0]), planes[1] - np.float32(128), planes[2] - np.float32(128)
    y = y + np.float32(0.5 + 1e-3)  # ties go up
    green = up[1](cb * np.float32(-0.344136)) + up[2](cr * np.float32(-0.714136))
    added = (up[2](cr * np.float32(1.402)), green, up[1](cb * np.float32(1.772)))
    return [np.clip(y + x, 0, 255).astype(np.uint8) for x in added]


def tensors(images: list[dict], coef: list[list[np.ndarray]]) -> list[list[np.ndarray]]:
    """Colour planes of each image; all blocks of a component are transformed at once."""
    out = []
    n = len(images[0]["components"]) if images else 0
    pixels = []
    for k in range(n):
        quants = {x["quant"][x["components"][k][3]] for x in images}
        if len(quants) > 1:
            return [t for x, c in zip(images, coef, strict=True) for t in tensors([x], [c])]
        pixels.append(samples(np.concatenate([c[k] for c in coef]), quants.pop()))
    at = [0] * n
    for image, size in zip(images, [[len(c) for c in x] for x in coef], strict=True):
        wide = max(c[1] for c in image["components"])
        planes = []
        for k in range(n):
            columns = image["width"] // 8 * image["components"][k][1] // wide
            blocks = pixels[k][at[k] : at[k] + size[k]]
            at[k] += size[k]
            planes.append(blocks.reshape(-1, columns, 8, 8).transpose(0, 2, 1, 3).reshape(-1, columns * 8))
        out.append(rgb(image, planes))
    return out


def payload(image: dict, coef: list[np.ndarray]) -> bytes:
    """The bytes an image was made to store."""
    found = re.fullmatch(rb"blocks (\d+)", image["comment"])
    if not found:
        raise ValueError("the image stores no payload")
    return np.concatenate(coef)[: int(found[1])].astype(np.uint8).tobytes()


# --- columns ------------------------------------------------------------------


def pad(text: str) -> bytes:
    raw = text.encode()
    return raw + bytes(-len(raw) % BLOCK or (0 if raw else BLOCK))


def _store(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for first, last in kernel.chunks(column, CHUNK_BYTES):
                texts = column.slice(first, last - first).to_pylist()
                rows = batch.slice(first, last - first)
                size = pa.array([len(t.encode()) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*map(rows.column, keep), size, pa.array(encode([pad(t) for t in texts]), pa.binary())], names=[*keep, "n_bytes", "media"])

    return run


def store(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``n_bytes`` and ``media``: each whole text as a progressive JPEG file.

    A null or empty text is one block of zeros; repeated rows give equal
    files; other columns are not read; an empty table gives no rows.
    """
    keep = kernel.without_made(keep, "n_bytes", "media")
    text = kernel.text_column(docs, *keep)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (text.schema[c] for c in keep))
    return text.mapInArrow(_store(list(keep)), f"{kept}, n_bytes long, media binary")


def features(planes: list[np.ndarray]) -> str:
    """Sides of the image, and mean and standard deviation of each colour."""
    height, width = planes[0].shape
    text = []
    for p in planes:
        x = p.ravel().astype(np.float64)  # sums of whole numbers, exact in any order
        total, squares = x.sum(), x @ x
        mean = total / x.size
        text.append(f"{mean:.3f}/{max(squares / x.size - mean * mean, 0) ** 0.5:.3f}")
    return f"{width}x{height} " + " ".join(text)


def _read_files(files: list[bytes | None]) -> list[tuple[bytes, list[np.ndarray]] | str]:
    """(payload, RGB planes) of each file, or why it can't be read; where one of many can't, each is read for itself."""
    if files == [None]:
        return ["no file"]
    try:
        images = [parse(f) for f in files]
        coef = coefficients(images)
        return list(zip([payload(i, c) for i, c in zip(images, coef, strict=True)], tensors(images, coef), strict=True))
    except Exception as e:  # a damaged file may fail anywhere in its bits
        return [x for f in files for x in _read_files([f])] if len(files) > 1 else [f"{type(e).__name__}: {e}"]


def _load(keep: list[str], with_tensor: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            media = batch.column("media")
            size = np.cumsum(pc.fill_null(pc.binary_length(media), 0).to_numpy(zero_copy_only=False))
            cut = np.searchsorted(size, np.arange(2 * CHUNK_BYTES, size[-1] if len(size) else 0, 2 * CHUNK_BYTES))
            cut = np.unique(np.concatenate([[0], cut, [len(media)]])).tolist()
            for first, last in zip(cut, cut[1:], strict=False):
                files = media.slice(first, last - first).to_pylist()
                found = _read_files(files)
                good = [None if isinstance(x, str) else x for x in found]
                of = lambda f, kind: pa.array([None if x is None else f(*x) for x in good], kind)  # noqa: B023, E731
                stored = lambda f, kind: pa.array([None if x is None else f(x) for x in files], kind)  # noqa: B023, E731
                rows = batch.slice(first, last - first)
                cols = [*map(rows.column, keep), of(lambda d, t: len(d), pa.int64()), of(lambda d, t: hashlib.sha256(d).hexdigest(), pa.string()), of(lambda d, t: zlib.crc32(d[-BLOCK:]), pa.int64())]
                cols += [stored(len, pa.int64()), stored(lambda f: hashlib.sha256(f).hexdigest(), pa.string()), of(lambda d, t: features(t), pa.string()), pa.array([x if isinstance(x, str) else None for x in found], pa.string())]
                names = [*keep, "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "reason"]
                if with_tensor:
                    cols += [of(lambda d, t: [*t[0].shape, 3], pa.list_(pa.int32())), of(lambda d, t: np.stack(t, axis=-1).tobytes(), pa.binary()), of(lambda d, t: d, pa.binary())]
                    names += ["shape", "rgb", "payload"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def load_media(media: DataFrame, keep: tuple[str, ...] = ("doc_id", "n_bytes"), with_tensor: bool = False) -> DataFrame:
    """Read stored files back: payload digests and image features; with ``with_tensor`` the RGB tensor and payload too.

    A null file, one that is damaged, of another kind, of sides that aren't
    whole units, or without a payload gives nulls and a ``reason``; its own
    size and digest stay.  Repeated rows are read each; a table without rows
    gives none; other columns are not read.
    """
    keep = kernel.without_made(keep, "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "reason", "media", *["shape", "rgb", "payload"] * with_tensor)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (media.schema[c] for c in keep))
    schema = f"{kept}, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, reason string"
    return media.select(*keep, "media").mapInArrow(_load(list(keep), with_tensor), schema + ", shape array<int>, rgb binary, payload binary" * with_tensor)
