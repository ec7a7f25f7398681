"""Vectorised word splitting and hashing over Arrow string columns.

A word is a run of bytes other than space and 0x09-0x0D; A-Z are lower-cased
first.  Hashes are 64-bit polynomial sums over a byte table, finished by a
bijective mixer, and equal on every executor.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19
_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finisher."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least n of each."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK)
        for key, base in (("up", _MULT), ("down", _INV)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _powers[key] = np.multiply.accumulate(row)
    return _powers["up"], _powers["down"]


class Words(NamedTuple):
    """Words of consecutive rows: row i has those from bounds[i] to bounds[i + 1]."""

    first: int
    bounds: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.bounds))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and UTF-8 bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    return offsets.astype(np.int64), np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)


def row_chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes each; a longer row stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, to
        at = to


def words(column: pa.Array, lower: bool = True) -> Iterator[Words]:
    """The words of a column, chunk by chunk."""
    offsets, data = text_bytes(column)
    for lo, hi in row_chunks(offsets):
        own = offsets[lo : hi + 1] - offsets[lo]
        piece = data[offsets[lo] : offsets[hi]]
        if lower:
            piece = piece + ((piece - np.uint8(65)) < 26) * np.uint8(32)
        n = len(piece)
        if not n:
            none = np.zeros(0, np.int64)
            yield Words(lo, np.zeros(hi - lo + 1, np.int64), np.zeros(0, np.uint64), none, none, piece)
            continue
        inside = ((piece - np.uint8(9)) > 4) & (piece != 32)
        cut = np.zeros(n + 1, dtype=bool)
        cut[own] = True
        before = np.empty(n, dtype=bool)
        before[0] = False
        before[1:] = inside[:-1]
        after = np.empty(n, dtype=bool)
        after[-1] = False
        after[:-1] = inside[1:]
        starts = np.flatnonzero(inside & (~before | cut[:-1]))
        ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        up, down = _pow(n)
        sums = np.empty(n + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[piece] * up[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * down[starts])
        yield Words(lo, np.searchsorted(starts, own), hashes, starts, ends, piece)


def shingles(hashes: np.ndarray, n: int = 5) -> np.ndarray:
    """Hashes of all runs of n words; of the whole sequence if it is shorter; none of nothing."""
    if not len(hashes):
        return hashes
    n_own = min(n, len(hashes))
    total = np.zeros(len(hashes) - n_own + 1, dtype=np.uint64)
    for i in range(n_own):
        total = total * np.uint64(_MULT) + hashes[i : len(hashes) - n_own + 1 + i]
    return mix(total ^ np.uint64(n_own))
