"""Words of whole texts as numpy arrays; used inside tasks, one chunk of documents at a time."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Characters that a chunk holds, about; a longer document is a chunk of its own.
CHUNK = 1 << 18
_P = 0x9E3779B97F4A7C15 | 1
TRIGRAM_BITS = 16
_SPACES = (9, 10, 11, 12, 13, 32)


def chunks(texts: list, most: int = CHUNK, empty: str | bytes = "") -> Iterator[tuple[int, list]]:
    """The texts in order, in lists of about ``most`` characters, each with the index of its first; null is ``empty``."""
    at, held, n = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t or empty)
        n += len(held[-1])
        if n >= most:
            yield at, held
            at, held, n = i + 1, [], 0
    if held:
        yield at, held


def codepoints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points with a line feed after each text, and where each text starts (and the end)."""
    cp = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return cp, starts


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_tables: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_tables[0]) < n:
        n = max(n, CHUNK + (CHUNK >> 1))
        for k, p in enumerate((_P, pow(_P, -1, 1 << 64))):
            t = np.full(n, p, np.uint64)
            t[0] = 1
            _tables[k] = np.cumprod(t, dtype=np.uint64)
    return _tables


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd number, modulo 2^64."""
    return _powers(n)[0][:n]


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true; the last value must be false."""
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def hash_runs(cp: np.ndarray, inside: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run's code points."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(cp))
    v = (cp.astype(np.uint64) + np.uint64(1)) * power[: len(cp)]
    v *= inside
    return mix(np.add.reduceat(v, starts) * inverse[starts])


@lru_cache
def _space_table() -> np.ndarray:
    t = np.ones(64, bool)
    t[list(_SPACES)] = False
    return t


def not_space(x: np.ndarray) -> np.ndarray:
    """Which code points, or bytes, are no ASCII white space."""
    return _space_table()[np.minimum(x, 63)]


def word_counts(texts: list[bytes]) -> np.ndarray:
    """The number of runs of bytes other than ASCII white space in each text."""
    inside = not_space(np.frombuffer(b"\n".join(texts) + b"\n", np.uint8))
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    return np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))))


def words(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every run of characters other than ASCII white space."""
    inside = not_space(cp)
    starts, ends = runs(inside)
    return starts, ends, hash_runs(cp, inside, starts)


@lru_cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letter_words(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Lower-cased code points, where each text starts, what are letters, and each word's start, end and text."""
    cp, at = codepoints([t.lower() for t in texts])
    inside = _letters()[cp]
    starts, ends = runs(inside)
    return cp, at, inside, starts, ends, np.searchsorted(at, starts, side="right") - 1


def trigrams(cp: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """For each place the bucket of the three characters around it; what is no letter is a word's edge."""
    c = np.where(inside, cp, 32).astype(np.uint32)
    left, right = np.empty_like(c), np.empty_like(c)
    left[0], left[1:], right[-1], right[:-1] = 32, c[:-1], 32, c[1:]
    x = (left * np.uint32(0x9E3779B1) ^ c) * np.uint32(0x85EBCA6B) ^ right
    return (x * np.uint32(0xC2B2AE35)) >> np.uint32(32 - TRIGRAM_BITS)
