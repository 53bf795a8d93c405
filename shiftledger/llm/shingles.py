"""Sets of five-word shingles of whole texts as 64-bit hashes."""

from __future__ import annotations

import numpy as np

from shiftledger.llm import textbytes as tb

WORDS = 5
BITS = 4096  # of a set's bitmap
_FACTORS = tb.mixed(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingle hashes in ascending order, and their number.

    A-Z count as a-z. A row of fewer than five words is one shingle, a row of none has none.
    """
    data = tb.LOWER[data]
    start, end, counts = tb.words(data, bounds)
    word = tb.substring_hash(tb.prefix_sums(data), start, end)
    first = np.cumsum(counts) - counts
    out: list[np.ndarray] = []
    rolled = np.zeros(0, np.uint64)
    if len(word) >= WORDS:
        last = len(word) - WORDS + 1
        rolled = word[:last] * _FACTORS[0]
        for j in range(1, WORDS):
            rolled = rolled + word[j : j + last] * _FACTORS[j]
        rolled = tb.mixed(rolled)
    sizes = np.zeros(len(counts), np.int64)
    for i, (a, n) in enumerate(zip(first.tolist(), counts.tolist())):
        if n >= WORDS:
            own = np.sort(rolled[a : a + n - WORDS + 1])
            keep = np.ones(len(own), bool)
            keep[1:] = own[1:] != own[:-1]
            own = own[keep]
        elif n:
            whole = (word[a : a + n] * _FACTORS[:n]).sum(dtype=np.uint64) + np.uint64(n)
            own = tb.mixed(np.array([whole], np.uint64))
        else:
            continue
        sizes[i] = len(own)
        out.append(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes


def set_hashes(tokens: np.ndarray, sizes: np.ndarray, seed: int = 1) -> np.ndarray:
    """One 64-bit hash of each set, whatever the order of its members; 0 for empty sets."""
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        first = (np.cumsum(sizes) - sizes)[some]
        sums = np.add.reduceat(tb.mixed(tokens ^ np.uint64(0x5851F42D4C957F2D * seed % 2**64)), first)
        out[some] = tb.mixed(sums + sizes[some].astype(np.uint64))
    return out.view(np.int64)


def bitmaps(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows of BITS bits as 64-bit words: the bits that the members hash to."""
    bits = np.zeros((len(sizes), BITS), bool)
    row = np.repeat(np.arange(len(sizes)), sizes)
    bits[row, (tokens % np.uint64(BITS)).astype(np.int64)] = True
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def wide_bitmaps(tokens: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """Of each set of more than BITS members a bitmap of as many bits, up to a power of two."""
    out: list[bytes | None] = [None] * len(sizes)
    first = np.cumsum(sizes) - sizes
    for i in np.flatnonzero(sizes > BITS):
        width = 1 << int(sizes[i] - 1).bit_length()
        bits = np.zeros(width, bool)
        bits[(tokens[first[i] : first[i] + sizes[i]] % np.uint64(width)).astype(np.int64)] = True
        out[i] = np.packbits(bits, bitorder="little").tobytes()
    return out


def folded(words: np.ndarray, size: int) -> np.ndarray:
    """A bitmap brought down to `size` 64-bit words, where it is wider."""
    while len(words) > size:
        half = len(words) // 2
        words = words[:half] | words[half:]
    return words
