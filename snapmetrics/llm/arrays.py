"""Vectorised text arithmetic on UTF-8 byte arrays (numpy, inside tasks).

ASCII white space is ``[\\x20\\x09-\\x0D]`` throughout.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
#: One random 64-bit value for each byte.
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
_STEPS = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        p = np.full(max(n, 256), BASE, np.uint64)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits (the finaliser of a 64-bit splitting generator)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def counts_by_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of set flags in each row of a byte array."""
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return c[off[1:]] - c[off[:-1]]


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, hash) of each word; words never cross rows."""
    inside = ~SPACE[raw]
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.empty(len(raw), bool)
    first[0] = True
    first[1:] = ~inside[:-1]
    first[off[:-1][off[:-1] < len(raw)]] = True
    starts = np.flatnonzero(first & inside)
    body = raw[inside]
    rank = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(inside, out=rank[1:])
    at = rank[starts]
    lengths = np.diff(at, append=len(body))
    place = np.arange(len(body)) - np.repeat(at, lengths)
    h = np.add.reduceat(BYTE_VALUES[body] * powers(int(lengths.max()) + 1)[place], at)
    row = np.searchsorted(off, starts, "right") - 1
    return row, starts, mix(h + lengths.astype(np.uint64) * BASE)


def windows(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of first word, hash) of each run of k words within a row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h += hashes[j : j + n] * _STEPS[j]
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    return at, mix(h[at])


def repeated(keys: np.ndarray) -> np.ndarray:
    """True for each key that occurs twice or more."""
    order = np.argsort(keys)
    s = keys[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out
