"""Run-length index of a collection of strings (numpy, one bucket at a time).

The suffixes of all strings are ordered; equal ones keep the strings' order,
as if every string ended with its own, ever larger end mark.  The
Burrows-Wheeler transform of that order is kept as runs, with a sample at
each run's head: the text position, and the length of its match with the
suffix before it.  Inside a run the matches of consecutive text positions
shift along with the text, so streaming over the text, each position's
matching statistic is the sample at or before it, less the distance.
"""

from __future__ import annotations

import numpy as np


def suffix_order(data: np.ndarray, rem: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; ``rem`` is each position's
    distance to its string's end.  Only tied suffixes are sorted again."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    at = np.arange(n)
    key = np.zeros(n, np.uint64)
    wide = np.zeros(n + 8, np.uint64)
    wide[:n] = data.astype(np.uint64) + np.uint64(1)
    for j in range(7):
        key = key << np.uint64(9) | np.where(rem > j, wide[j : j + n], np.uint64(0))
    del wide
    order = np.argsort(key)
    first = np.ones(n, bool)
    first[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, at, 0)) + 1
    depth, longest = 7, int(rem.max(initial=0))
    # Rows whose class has one member are final.
    tied = ~(first & np.append(first[1:], True))
    while depth < longest and tied.any():
        rows = np.flatnonzero(tied)
        pos = order[rows]
        second = np.where(rem[pos] > depth, rank[np.minimum(pos + depth, n - 1)], 0)
        key = rank[pos].astype(np.uint64) << np.uint64(32) | second.astype(np.uint64)
        by = np.argsort(key)
        key, pos = key[by], pos[by]
        old = (key >> np.uint64(32)).astype(np.int64)
        head = np.ones(len(old), bool)
        head[1:] = old[1:] != old[:-1]
        start = np.maximum.accumulate(np.where(head, np.arange(len(old)), 0))
        row = old - 1 + np.arange(len(old)) - start
        order[row] = pos
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        rank[pos] = np.maximum.accumulate(np.where(new, row, 0)) + 1
        tied = np.zeros(n, bool)
        tied[row] = ~(new & np.append(new[1:], True))
        depth *= 2
    # Equal suffixes, in the order of their strings.
    rows = np.flatnonzero(tied)
    pos = order[rows]
    order[rows] = pos[np.argsort(rank[pos].astype(np.uint64) << np.uint64(32) | pos.astype(np.uint64))]
    return order


def common_prefix(data: np.ndarray, rem: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Length of the match of positions p and q within their strings."""
    padded = np.append(data, np.zeros(8, np.uint8)).astype(np.uint64)
    word = np.zeros(len(data), np.uint64)
    for j in range(8):
        word |= padded[j : j + len(data)] << np.uint64(8 * j)
    limit = np.minimum(rem[p], rem[q])
    out = limit.copy()
    live = np.arange(len(p))
    off = 0
    while live.size:
        x = word[p[live] + off] ^ word[q[live] + off]
        low = x & (~x + np.uint64(1))
        same = np.where(x == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(float)).astype(np.int64) >> 3)
        end = (same < 8) | (off + 8 >= limit[live])
        done = live[end]
        out[done] = np.minimum(off + same[end], limit[done])
        live = live[~end]
        off += 8
    return out


class RunIndex:
    """Runs, samples and matching statistics of the strings that lie one after
    another in ``data``, with ``starts`` as their first positions."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        n = len(data)
        ends = np.append(starts[1:], n)
        self.rem = np.repeat(ends, ends - starts) - np.arange(n)
        self.order = order = suffix_order(data, self.rem)
        begins = np.zeros(n, bool)
        begins[starts] = True
        before = np.append(np.uint8(0), data[:-1])[order]
        cut = begins[order]
        head = np.ones(n, bool)
        head[1:] = (before[1:] != before[:-1]) | cut[1:] | cut[:-1]
        #: The run-length transform: a run's letter and its first row.
        self.run_rows = np.flatnonzero(head)
        self.run_letters = before[self.run_rows]
        p, q = order[self.run_rows], order[np.maximum(self.run_rows - 1, 0)]
        match = common_prefix(data, self.rem, p, q)
        match[self.run_rows == 0] = 0
        by = np.argsort(p)
        self.sample_at, self.sample_match = p[by], match[by]

    def statistics(self) -> np.ndarray:
        """Of each text position, the length of its match with the suffix
        before it in the order, streamed from the run samples."""
        n = len(self.order)
        last = np.zeros(n, np.int64)
        last[self.sample_at] = np.arange(len(self.sample_at))
        last = np.maximum.accumulate(last)
        return self.sample_match[last] - (np.arange(n) - self.sample_at[last])

    def repeats(self, length: int) -> np.ndarray:
        """True at each position whose next ``length`` bytes also start at an
        earlier position.  Neighbours in the order that match that long form
        one class; its first text position is the original."""
        far = self.statistics()[self.order] < length
        far[0] = True
        starts = np.flatnonzero(far)
        least = np.minimum.reduceat(self.order, starts)
        out = np.zeros(len(self.order), bool)
        out[self.order] = self.order != least[np.cumsum(far) - 1]
        return out
