"""Whole texts of an Arrow batch as bytes: word bounds and 64-bit word hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MULT = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULT, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _grown(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        _powers = (_grown(_MULT, size), _grown(_INVERSE, size))
    return _powers[0][:n], _powers[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits (an invertible finaliser, so unequal values stay unequal)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix hashes; substring_hash() reads any substring's hash from them."""
    out = np.zeros(len(data) + 1, np.uint64)
    if len(data):
        pw, _ = powers(len(data))
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * pw, out=out[1:])
    return out


def substring_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inverse = powers(len(sums))
    return mixed((sums[end] - sums[start]) * inverse[start])


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (null: empty) and each row's bounds in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def joined(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of some texts and each one's bounds in them."""
    return np.frombuffer(b"".join(raws), np.uint8), np.append(0, np.cumsum([len(r) for r in raws], dtype=np.int64))


def pieces(data: np.ndarray, bounds: np.ndarray, size: int = 1 << 19) -> Iterator[tuple]:
    """Consecutive whole rows of about `size` bytes: (first row, next row, bytes, bounds)."""
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        last = min(rows, max(last, first + 1))
        base = bounds[first]
        yield first, last, data[base : bounds[last]], bounds[first : last + 1] - base
        first = last


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a run ends where its row ends."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    edges = bounds[:-1][bounds[:-1] < bounds[1:]]
    begin[edges] = inside[edges]
    last = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    stop[last] = inside[last]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word (bytes other than space and \\x09-\\x0D), words per row."""
    start, end = runs(~SPACE[data], bounds)
    return start, end, np.diff(np.searchsorted(start, bounds))
