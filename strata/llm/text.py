"""Array helpers for text inside Arrow tasks: words, hashes, shingles, groups.

All functions work on the UTF-8 bytes of an Arrow string column, a few MB at a
time, so that memory does not depend on the batch. Byte classes are enough
for the word rules used here, because every byte of a non-ASCII character is
0x80 or more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: bytes of text worked on at once
CHUNK = 2 << 20
#: bytes hashed at once
PIECE = 1 << 19

_MULT = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_STEP = 0xD1342543DE82EF95  # odd, so that it has an inverse modulo 2^64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


#: one random-looking 64-bit value per byte
SYMBOL = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_MULT))
_POW: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of _STEP and of its inverse, made on first use in a worker."""
    if not _POW:
        n = PIECE + 1
        for base in (_STEP, pow(_STEP, -1, 1 << 64)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POW.append(np.cumprod(steps, dtype=np.uint64))
    return _POW[0], _POW[1]


def byte_class(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


#: A-Z to a-z, other bytes as they are
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: separators 0x20 and 0x09-0x0D
SPACES = byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")
NOT_SPACE = ~SPACES
#: after lower-casing: digits, a-z and all bytes of non-ASCII characters
ALNUM = byte_class(b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, size: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``size`` bytes (else CHUNK): (first row, last row + 1, bytes, offsets)."""
    data, offsets = utf8(column)
    size = size or CHUNK
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of the runs of True, which never cross a row's edge."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0] = after[-1] = False
    before[1:], after[:-1] = inside[:-1], inside[1:]
    filled = offsets[:-1] < offsets[1:]
    before[offsets[:-1][filled]] = False
    after[offsets[1:][filled] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes (spans ascending and disjoint).

    A polynomial over per-byte values: a running sum gives every span's value,
    and the inverse power makes it independent of the span's position.
    """
    out = np.zeros(len(starts), np.uint64)
    power, inverse = _powers()
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + PIECE, "right"))
        if j <= i:  # one span longer than a piece
            total, at, end = 0, base, int(ends[i])
            while at < end:
                part = data[at:min(end, at + PIECE)]
                value = int((SYMBOL[part] * power[:len(part)]).sum(dtype=np.uint64))
                total = (total + value * pow(_STEP, at - base, 1 << 64)) & _MASK
                at += len(part)
            out[i] = total
            i += 1
            continue
        part = data[base:int(ends[j - 1])]
        run = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(SYMBOL[part] * power[:len(part)], dtype=np.uint64, out=run[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (run[e] - run[s]) * inverse[s]
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(_MULT))


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray,
          lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row: start bytes, end bytes, hashes, and per row the index of its first word."""
    if lower:
        data = LOWER[data]
    starts, ends = spans(inside[data], offsets)
    first = np.searchsorted(starts, offsets)
    return starts, ends, span_hashes(data, starts, ends), first


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per row the hashes of its k-word shingles; of fewer words, one for the whole row."""
    scale = [np.uint64(pow(_STEP, 2 * j + 1, 1 << 64)) for j in range(k)]
    n = len(hashes) - k + 1
    full = np.zeros(max(n, 0), np.uint64)
    for j in range(k if n > 0 else 0):
        full += hashes[j:j + n] * scale[j]
    full = mix(full)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            yield full[a:b - k + 1]
        elif b > a:
            value = sum(int(h) * int(scale[j]) for j, h in enumerate(hashes[a:b])) & _MASK
            yield mix(np.array([value + (b - a) * _MULT & _MASK], np.uint64))
        else:
            yield full[:0]


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type)
         for f in schema], schema=schema)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of equal keys from batches that are sorted by them, one at a time."""
    held: list[pa.RecordBatch] = []

    def key(b: pa.RecordBatch, i: int) -> tuple:
        return tuple(b.column(b.schema.get_field_index(k))[i].as_py() for k in keys)

    for b in batches:
        n = b.num_rows
        if not n:
            continue
        change = np.zeros(max(n - 1, 0), bool)
        for k in keys:
            c = b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), n]
        if held and key(held[-1], held[-1].num_rows - 1) != key(b, 0):
            yield pa.Table.from_batches(held)
            held = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            held.append(b.slice(lo, hi - lo))
            if hi < n:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


class Memo:
    """Values of 64-bit keys seen by this task, as sorted arrays of bounded size.

    ``values(keys, make)`` returns one row per key; ``make(index)`` gets the
    positions (in ``keys``) of distinct keys not seen yet. At ``limit`` entries
    it starts afresh, so memory is bounded and results never depend on it.
    """

    def __init__(self, width: int, dtype, limit: int = 1 << 20):
        self.limit = limit
        self.keys = np.zeros(0, np.uint64)
        self.rows = np.zeros((0, width), dtype)

    def values(self, keys: np.ndarray, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        distinct, where, back = np.unique(keys, return_index=True, return_inverse=True)
        out = np.zeros((len(distinct), self.rows.shape[1]), self.rows.dtype)
        known = np.zeros(len(distinct), bool)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
            known = self.keys[at] == distinct
            out[known] = self.rows[at[known]]
        if not known.all():
            out[~known] = make(where[~known])
            if len(self.keys) + np.count_nonzero(~known) > self.limit:
                self.keys, self.rows = self.keys[:0], self.rows[:0]
            at = np.searchsorted(self.keys, distinct[~known])
            self.keys = np.insert(self.keys, at, distinct[~known])
            self.rows = np.insert(self.rows, at, out[~known], axis=0)
        return out[back]
