"""Vectorised word and shingle hashing over Arrow string arrays.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``. Word hashes are 64-bit polynomial
sums over the bytes, finished by a mixing step; shingle hashes combine consecutive word hashes. All
functions work on slices of about ``SLICE_BYTES`` of text, so that memory stays small however many
rows an Arrow batch holds (a single longer text is one slice of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
U = np.uint64

WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True

_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=U) * U(2) + U(1)
_BYTE[WHITE] = 0
_BASE = U(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=U) * U(2) + U(1)
_powers = np.ones(1, U)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the polynomial base modulo 2^64."""
    global _powers
    if len(_powers) < n:
        p = np.full(max(n, 2 * len(_powers)), _BASE, U)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers[:n]


def mix(z: np.ndarray) -> np.ndarray:
    z = z ^ (z >> U(30))
    z *= U(0xBF58476D1CE4E5B9)
    z ^= z >> U(27)
    z *= U(0x94D049BB133111EB)
    z ^= z >> U(31)
    return z


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string array (null: empty text)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, one row at least."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j
        i = j


@dataclass
class Words:
    """Words of some rows: ``hash`` per word, byte ranges ``start``/``end`` in ``buf``, and row ``r``
    owning the words ``first[r]:first[r + 1]``."""
    buf: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split_words(data: np.ndarray, off: np.ndarray) -> Words:
    buf, bounds = data[off[0]:off[-1]], off - off[0]
    white = WHITE[buf]
    begin, last = ~white, ~white
    begin[1:] &= white[:-1]
    last[:-1] &= white[1:]
    inner = bounds[:-1][np.diff(bounds) > 0]
    begin[inner] = ~white[inner]
    ends = bounds[1:][np.diff(bounds) > 0] - 1
    last[ends] = ~white[ends]
    start, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
    first = np.searchsorted(start, bounds)
    if not len(start):
        return Words(buf, np.zeros(0, U), start, end, first)
    place = np.arange(start[0], len(buf)) - np.repeat(start, np.diff(np.append(start, len(buf))))
    part = _BYTE[buf[start[0]:]]
    part *= powers(int(place.max()) + 1)[place]
    return Words(buf, mix(np.add.reduceat(part, start - start[0])), start, end, first)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``size`` consecutive words of a row, in order; a row with fewer
    words, but at least one, has the single shingle of all its words."""
    n = len(w.hash)
    counts = np.diff(w.first)
    row = w.row_of()
    left = w.first[1:][row] - np.arange(n)  # words from here to the row's end
    full = left >= size
    z = np.zeros(n, U)
    for j in range(size):
        if j < n:
            z[:n - j] += w.hash[j:] * _PLACE[j]
    short = np.flatnonzero((counts > 0) & (counts < size))
    keep = full
    if len(short):
        keep = full.copy()
        for r in short:
            a, b = w.first[r], w.first[r + 1]
            z[a] = (w.hash[a:b] * _PLACE[:b - a]).sum(dtype=U) + U(b - a)
            keep[a] = True
    return mix(z[keep]), row[keep]
