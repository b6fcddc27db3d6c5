"""Hashes of words and windows, computed over whole blocks of bytes at once."""

from __future__ import annotations

import numpy as np

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x5851F42D4C957F2D)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= M1
    x ^= x >> np.uint64(27)
    x *= M2
    x ^= x >> np.uint64(31)
    return x


class Kept(dict):
    """What a process keeps for itself: it is sent with tasks empty."""

    def __reduce__(self):
        return Kept, ()


_kept = Kept()


def _row(base: int, size: int) -> np.ndarray:
    row = np.full(size, np.uint64(base), dtype=np.uint64)
    row[0] = 1
    return np.cumprod(row, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    size = max(1 << n.bit_length(), 1 << 21)
    if size not in _kept:
        _kept[size] = _row(int(_BASE), size), _row(int(_BASE_INVERSE), size)
    return _kept[size]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and the number of words of every text.

    Words are runs of bytes other than 0x20 and 0x09-0x0D; they end with their text.
    """
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets) - 1, np.int64)
    word = ~SPACES[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:n]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (polynomial in its bytes, mixed) and words per text."""
    starts, ends, counts = word_bounds(data, offsets)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), counts
    up, down = _tables(len(data) + 1)
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], dtype=np.uint64, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]), counts


def shingle_sets(words: np.ndarray, counts: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text.

    A text of fewer than ``size`` words has its whole sequence as the one shingle; a
    text without words has none.
    """
    n = len(words)
    rolled = words.copy()
    for k in range(1, size):
        if n > k:
            rolled[:n - k] = mix(rolled[:n - k] * STEP + words[k:])
    out, at = [], 0
    for count in counts.tolist():
        if count >= size:
            out.append(np.unique(rolled[at:at + count - size + 1]))
        elif count:
            whole = np.array([count], dtype=np.uint64)
            for k in range(at, at + count):
                whole = mix(whole * STEP + words[k:k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
        at += count
    return out
