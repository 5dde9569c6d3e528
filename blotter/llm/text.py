"""Numpy helpers over Arrow string columns: words, word hashes, window hashes.

All helpers work on one flat UTF-8 buffer holding many documents, so a task
never loops over words in Python. Words are ``[^\\x20\\x09-\\x0D]+``; the
separators are single ASCII bytes, so splitting the bytes is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEP = np.zeros(256, dtype=bool)
SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xBF58476D1CE4E5B9)
_K3 = np.uint64(0x94D049BB133111EB)
_MASKS = np.array([0xFFFFFFFFFFFFFFFF] + [(1 << (8 * i)) - 1 for i in range(1, 8)], dtype=np.uint64)
#: Bytes of text handled at once; bounds a task's temporaries (a longer
#: document is handled alone).
SLICE_BYTES = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; changes ``x`` in place and returns it."""
    x ^= x >> np.uint64(30)
    x *= _K2
    x ^= x >> np.uint64(27)
    x *= _K3
    x ^= x >> np.uint64(31)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of documents of at most ``limit`` bytes each (at least one document)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


@dataclass
class Words:
    """Words of many documents: byte spans, and each document's first word."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # documents + 1

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = False, sep: np.ndarray = SEP) -> Words:
    """Split every document of the buffer into words; ``sep`` marks the bytes between them."""
    if lower:
        raw = _LOWER[raw]
    if len(raw) == 0:
        z = np.zeros(0, np.int64)
        return Words(raw, z, z, np.zeros(len(offsets), np.int64))
    inside = ~sep[raw]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cuts = offsets[:-1][np.diff(offsets) > 0]
    begin[cuts] = inside[cuts]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    last = cuts[1:] - 1
    stop[last] = inside[last]
    start = np.flatnonzero(begin)
    end = np.flatnonzero(stop) + 1
    return Words(raw, start, end, np.searchsorted(start, offsets))


def hash_spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of every byte span, eight bytes at a time."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    size = (end - start).astype(np.int64)
    h = mix(size.astype(np.uint64) * _K1 + np.uint64(seed))
    left, at = size, start
    active = np.arange(len(start))
    while len(active):
        chunk = eight[at] & _MASKS[np.where(left >= 8, 0, left)]
        whole = len(active) == len(h)
        new = mix(((h if whole else h[active]) ^ chunk) * _K1)
        if whole:
            h = new
        else:
            h[active] = new
        more = left > 8
        active, at, left = active[more], at[more] + 8, left[more] - 8
    return h


def window_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` consecutive values from every position (length
    ``len(h) - k + 1``), by doubling."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, used, size, part = None, 0, 1, h
    power = 0xD6E8FEB86659FD93
    while True:
        if k & size:
            piece = part[used:used + n]
            total = piece.copy() if total is None else total * np.uint64(power) + piece
            used += size
        if used == k:
            return mix(total ^ np.uint64(k))
        part = part[:-size] * np.uint64(power) + part[size:] if len(part) > size else part[:0]
        power = power * power % (1 << 64)
        size *= 2


def window_starts(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """Mask over ``n`` positions: a window of ``k`` words there stays in its document."""
    ok = np.zeros(max(0, n), dtype=bool)
    count = np.diff(first) - k + 1
    for_docs = count > 0
    if n <= 0 or not for_docs.any():
        return ok
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, first[:-1][for_docs], 1)
    np.add.at(edge, np.minimum(first[:-1][for_docs] + count[for_docs], n), -1)
    return np.cumsum(edge[:-1]) > 0


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenated ``start[i] .. start[i] + size[i] - 1``."""
    total = int(size.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(size)
    return np.arange(total) + np.repeat(start - (ends - size), size)
