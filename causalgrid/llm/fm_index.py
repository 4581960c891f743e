"""A compressed full-text index of one shard's segments, and matching statistics over it.

The Burrows-Wheeler transform of the segments is kept as a wavelet matrix of packed bits, so a backward step costs one bit rank a
level for both ends of an interval. Numpy takes the same step for all streamed segments at once.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, by doubling, and the ranks of all places after each doubling (by 1, 2, 4... symbols)."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    ranks, step = [rank.astype(np.int32)], 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[: n - step] = rank[step:] + 1
        pair = rank * (n + 1) + follow
        order = np.argsort(pair)
        ordered = pair[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        if rank[order[-1]] == n - 1:
            return order, ranks
        ranks.append(rank.astype(np.int32))
        step *= 2


def shared_lengths(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Symbols that each suffix in order shares with the one before; zero at both ends, one longer than ``order``."""
    n = len(order)
    a, b = order[1:].copy(), order[:-1].copy()
    shared = np.zeros(n + 1, np.int32)
    for k in range(len(ranks) - 1, -1, -1):
        inside = (a < n) & (b < n)
        equal = inside & (ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)])
        shared[1:n] += equal.astype(np.int32) << k
        a += equal.astype(np.int64) << k
        b += equal.astype(np.int64) << k
    return shared


class WaveletMatrix:
    """Ranks in a sequence of symbols, a level of packed bits for each binary digit."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.shifts = range(max(1, int(size - 1).bit_length()) - 1, -1, -1)
        self.words, self.before, self.zeros = [], [], []
        n = len(symbols)
        for shift in self.shifts:
            bits = (symbols >> shift) & 1
            padded = np.zeros((n // 64 + 1) * 64, np.uint8)
            padded[:n] = bits
            words = np.packbits(padded, bitorder="little").view("<u8")
            self.words.append(words)
            self.before.append(np.r_[0, np.cumsum(np.bitwise_count(words).astype(np.int64))[:-1]].astype(np.int32))
            self.zeros.append(n - int(bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        counts = np.bincount(symbols, minlength=size)
        #: where a symbol's run begins on the last level, against where it begins in sorted order
        start = np.zeros(size, np.int64)
        runs = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        start[symbols[runs]] = runs
        self.shift_to_sorted = np.cumsum(counts) - counts - start

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Backward step: the place in order that ``at`` goes to when ``symbol`` is put before; ``symbol`` has to occur."""
        one = np.uint64(1)
        place = at
        for shift, words, before, zeros in zip(self.shifts, self.words, self.before, self.zeros):
            word = place >> 6
            below = (one << (place & 63).astype(np.uint64)) - one
            ones = before[word] + np.bitwise_count(words[word] & below)
            place = np.where((symbol >> shift) & 1, zeros + ones, place - ones)
        return place + self.shift_to_sorted[symbol]


class Minima:
    """Least values of ranges, and how far values stay at or above a bound; each level covers twice as many."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[: len(last) - width], last[width:]))
            width *= 2

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of ``values[lo:hi]``, none of them empty."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            row = self.levels[k]
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << int(k))])
        return out

    def down(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The least ``p <= at`` with all of ``values[p+1 .. at]`` at or above ``bound``."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            width = 1 << k
            begin = at - width + 1
            fits = begin >= 1
            fits[fits] = self.levels[k][begin[fits]] >= bound[fits]
            at[fits] -= width
        return at

    def up(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The largest ``p >= at``, the last place at most, with all of ``values[at .. p-1]`` at or above ``bound``."""
        at, n = at.copy(), len(self.levels[0]) - 1
        for k in range(len(self.levels) - 1, -1, -1):
            width = 1 << k
            fits = at + width <= n
            fits[fits] = self.levels[k][at[fits]] >= bound[fits]
            at[fits] += width
        return at


class SegmentIndex:
    """Index of segments, each a row of symbols (0 and up) with a number that says how early its owner comes."""

    def __init__(self, segments: list[np.ndarray], owners: np.ndarray):
        self.sizes = np.array([len(s) for s in segments])
        self.begins = np.cumsum(self.sizes + 1) - self.sizes - 1
        ends = self.begins + self.sizes
        self.text = np.zeros(int((self.sizes + 1).sum()), np.int64)
        inside = np.ones(len(self.text), bool)
        inside[ends] = False
        self.text[inside] = np.concatenate(segments) + 1
        # ends of segments differ, so no suffix goes on into the next one; in the transform they are one symbol
        apart = self.text + len(segments)
        apart[ends] = np.arange(len(segments))
        order, ranks = suffix_order(apart)
        shared = shared_lengths(order, ranks)
        self.n = len(order)
        self.matrix = WaveletMatrix(self.text[order - 1], int(self.text.max()) + 1)
        self.owners = owners
        self.owner = Minima(np.repeat(owners, self.sizes + 1)[order])
        self.shared = Minima(shared)

    def matching_lengths(self) -> np.ndarray:
        """For each place of each segment, in order, the symbols from there on that an earlier owner's segment has too.

        Segments are read from their ends. An interval that no earlier owner shares is widened to its parent's until one does.
        """
        out = np.zeros(len(self.text), np.int32)
        at, begin, own = self.begins + self.sizes - 1, self.begins, self.owners
        lo, hi, size = np.zeros(len(at), np.int64), np.full(len(at), self.n), np.zeros(len(at), np.int64)
        shared = self.shared.levels[0]
        while len(at):
            symbol = self.text[at]
            both = self.matrix.step(np.r_[symbol, symbol], np.r_[lo, hi])
            low, high = both[: len(at)], both[len(at) :]
            more = low < high
            more[more] = self.owner.least(low[more], high[more]) < own[more]
            lo, hi, size = np.where(more, low, lo), np.where(more, high, hi), size + more
            out[at[more]] = size[more]
            narrow = np.flatnonzero(~more & (size > 0))
            if len(narrow):
                size[narrow] = np.maximum(shared[lo[narrow]], shared[hi[narrow]])
                lo[narrow] = self.shared.down(lo[narrow], size[narrow])
                hi[narrow] = self.shared.up(hi[narrow], size[narrow])
                more[narrow] = False
            at = at - 1
            at[narrow] += 1
            left = at >= begin
            if not left.all():
                at, begin, own, lo, hi, size = (x[left] for x in (at, begin, own, lo, hi, size))
        return out
