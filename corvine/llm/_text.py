"""Whole-batch text primitives over Arrow buffers: word spans, hashes of spans, ragged helpers.

Everything works on one flat uint8 array per batch plus offsets, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64

#: Bytes that separate words: [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_TAIL = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=U64)


#: Rows of a slice at most; row numbers in a slice are packed into few bits.
ROWS = 8192


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    else:
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8)[lo:hi] if data is not None and hi > lo else np.zeros(0, np.uint8)
    return raw, offsets - lo


def pieces(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `most` bytes of the column each, of one row to `ROWS`."""
    for start, rows in _cuts(batch.column(column), most):
        yield batch.slice(start, rows)


def column_pieces(column: pa.Array, most: int = 1 << 20) -> Iterator[pa.Array]:
    """The same for a single column."""
    for start, rows in _cuts(column, most):
        yield column.slice(start, rows)


def _cuts(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    _, offsets = flat(column)
    start, n = 0, len(column)
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        stop = min(n, start + ROWS, max(stop, start + 1))
        yield start, stop - start
        start = stop


def spans(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of member bytes that stay inside one document: starts, ends, and words before each document."""
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first = np.zeros(len(member) + 1, bool)
    first[offsets] = True
    begins = member.copy()
    begins[1:] &= ~member[:-1] | first[1:-1]
    stops = member.copy()
    stops[:-1] &= ~member[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets, "left")


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spans(~SPACE[data], offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (in place)."""
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


def lanes(data: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit integer that starts at each byte, and at the end."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 8,), "<u8", padded, strides=(1,))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same in every process."""
    length = ends - starts
    h = mix(length.astype(U64) + U64(seed * 2 + 1))
    if not len(starts):
        return h
    at = lanes(data)
    rows, done = np.flatnonzero(length > 0), 0
    while len(rows):
        rest = length[rows] - done
        lane = at[starts[rows] + done] & _TAIL[np.minimum(rest, 8)]
        if len(rows) == len(h):
            h = mix(h ^ lane)
        else:
            h[rows] = mix(h[rows] ^ lane)
        done += 8
        rows = rows[rest > 8]
    return h


class HashIndex:
    """Places of 64-bit hashes in a sorted array, through a directory of their top bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.append(hashes, U64(0xFFFFFFFFFFFFFFFF))
        self.shift = U64(64 - max(1, len(hashes).bit_length()))
        count = np.bincount((hashes >> self.shift).astype(np.int64), minlength=1 << int(64 - self.shift))
        self.first = (np.cumsum(count) - count).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is not there."""
        at = self.first[(keys >> self.shift).astype(np.int64)].astype(np.int64)
        todo = np.flatnonzero(self.hashes[at] < keys)
        while len(todo):
            at[todo] += 1
            todo = todo[self.hashes[at[todo]] < keys[todo]]
        at[(self.hashes[at] != keys) | (at == len(self.hashes) - 1)] = -1
        return at


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of the given lengths laid end to end: each item's row, and its place in the row."""
    lengths = np.asarray(lengths, np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    return row, np.arange(len(row)) - first[row]


# XXH64 of many spans at once; the five primes are fixed values of the published algorithm.
_P1, _P2, _P3, _P4, _P5 = (U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U64(by)) | (x >> U64(64 - by))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * _P2, 31) * _P1


def xxh64_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of each span's bytes."""
    with np.errstate(over="ignore"):
        s = U64(seed)
        length = ends - starts
        h = np.full(len(starts), s + _P5, U64)
        if not len(starts):
            return h
        at = lanes(data)
        pos = starts.copy()
        rows = np.flatnonzero(length >= 32)
        if len(rows):
            acc = [np.full(len(rows), x, U64) for x in (s + _P1 + _P2, s + _P2, s, s - _P1)]
            left, p, live = length[rows].copy(), pos[rows].copy(), np.arange(len(rows))
            while len(live):
                for j in range(4):
                    acc[j][live] = _round(acc[j][live], at[p[live] + 8 * j])
                p[live] += 32
                left[live] -= 32
                live = live[left[live] >= 32]
            merged = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
            for a in acc:
                merged = (merged ^ _round(np.zeros_like(a), a)) * _P1 + _P4
            h[rows], pos[rows] = merged, p
        h += length.astype(U64)
        rows = np.flatnonzero(ends - pos >= 8)
        while len(rows):
            h[rows] = _rotl(h[rows] ^ (_rotl(at[pos[rows]] * _P2, 31) * _P1), 27) * _P1 + _P4
            pos[rows] += 8
            rows = rows[ends[rows] - pos[rows] >= 8]
        rows = np.flatnonzero(ends - pos >= 4)
        if len(rows):
            h[rows] = _rotl(h[rows] ^ ((at[pos[rows]] & U64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
            pos[rows] += 4
        rows = np.flatnonzero(ends > pos)
        while len(rows):
            h[rows] = _rotl(h[rows] ^ ((at[pos[rows]] & U64(0xFF)) * _P5), 11) * _P1
            pos[rows] += 1
            rows = rows[ends[rows] > pos[rows]]
        h ^= h >> U64(33)
        h *= _P2
        h ^= h >> U64(29)
        h *= _P3
        h ^= h >> U64(32)
        return h


def strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())
