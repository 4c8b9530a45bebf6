"""FM-index over the words of one training shard, in numpy.

The shard is a sequence of symbols: known words have their vocabulary number
(from 1), every stretch of other words and every document start is a separator
(0). Each separator counts as a symbol of its own, smaller than all words, so
all suffixes differ and no phrase runs over a separator.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8  # every so many positions is kept for locating


def suffix_ranks(seq: np.ndarray) -> np.ndarray:
    """Rank of every suffix of ``seq`` (which ends with 0), by prefix doubling."""
    n = len(seq)
    separators = seq == 0
    n_sep = int(separators.sum())
    size = np.bincount(seq, minlength=1)
    size[0] = 0
    first = n_sep + np.cumsum(size) - size  # of each symbol's first row
    rank = first[seq]
    rank[separators] = np.arange(n_sep)
    active = np.flatnonzero(size[seq] > 1)
    step = 1
    while len(active):
        key = rank[active] * n + rank[active + step]
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        group = np.ones(len(key), bool)
        old = key // n
        group[1:] = old[1:] != old[:-1]
        at = np.arange(len(key))
        begin_new = np.maximum.accumulate(np.where(new, at, 0))
        begin_group = np.maximum.accumulate(np.where(group, at, 0))
        rank[active] = old + begin_new - begin_group
        alone = new.copy()
        alone[:-1] &= new[1:]
        active = np.sort(active[~alone])
        step *= 2
    return rank


class FMIndex:
    """Counts and locates phrases of symbols from 1 to ``sigma``."""

    def __init__(self, seq: np.ndarray, sigma: int):
        n = len(seq)
        rank = suffix_ranks(seq)
        suffix = np.empty(n, np.int64)
        suffix[rank] = np.arange(n)
        last = np.where(suffix > 0, seq[suffix - 1], 0)  # Burrows-Wheeler transform
        size = np.bincount(seq, minlength=sigma + 1)
        self.n = n
        self.first = np.concatenate(([0], np.cumsum(size)))[: sigma + 1]
        self.bits = max(1, int(sigma).bit_length())
        self.ones: list[np.ndarray] = []  # ones before each place, by level
        self.zeros: list[int] = []
        level = last
        for b in range(self.bits - 1, -1, -1):
            bit = (level >> b) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(n - int(bit.sum()))
            level = np.concatenate((level[bit == 0], level[bit == 1]))
        self.last = last
        kept = (last == 0) | (suffix % SAMPLE == 0)
        self.sampled = np.where(kept, suffix, -1)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands in the transform before row ``at``."""
        lo, hi = np.zeros_like(at), at
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one = (symbol >> (self.bits - 1 - k)) & 1 == 1
            a, b = ones[lo], ones[hi]
            lo = np.where(one, zeros + a, lo - a)
            hi = np.where(one, zeros + b, hi - b)
        return hi - lo

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of rows of ``phrases``: (phrase number, first row, row after the last)."""
        alive = np.arange(len(phrases))
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        done = []
        step = 0
        while len(alive):
            symbol = phrases[alive, lengths[alive] - 1 - step]
            lo = self.first[symbol] + self.rank(symbol, lo)
            hi = self.first[symbol] + self.rank(symbol, hi)
            step += 1
            whole = (lo < hi) & (lengths[alive] == step)
            done.append((alive[whole], lo[whole], hi[whole]))
            on = (lo < hi) & ~whole
            alive, lo, hi = alive[on], lo[on], hi[on]
        return tuple(np.concatenate(x) for x in zip(*done)) if done else (alive, lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of the suffixes in ``rows``: walks back to a sampled one."""
        found = np.empty(len(rows), np.int64)
        open_, row, steps = np.arange(len(rows)), rows, 0
        while len(open_):
            place = self.sampled[row]
            hit = place >= 0
            found[open_[hit]] = place[hit] + steps
            open_, row = open_[~hit], row[~hit]
            symbol = self.last[row]
            row = self.first[symbol] + self.rank(symbol, row)
            steps += 1
        return found
