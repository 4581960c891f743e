"""Suffix arrays by induced sorting, and permuted common prefixes, of one shard's text.

Suffixes are classified as smaller (S) or larger (L) than the next one. The leftmost S suffixes of each run
(LMS) are sorted by induction over their substrings, named, and, where names repeat, sorted by recursion; the order of
all suffixes is then induced from theirs. Induction runs bucket by bucket, and numpy moves all that a bucket
induces at once, so a byte alphabet needs some hundred steps for any length. The recursion's string of names has a large
alphabet and a third of the length or less; there single steps are taken.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is S; the last suffix is S."""
    n = len(t)
    s = np.empty(n, bool)
    differ = np.flatnonzero(t[:-1] != t[1:])
    # a suffix has the type of the end of its run of equal symbols
    s[:] = True
    if len(differ):
        rising = t[differ] < t[differ + 1]
        lengths = np.diff(np.r_[-1, differ])
        s[: differ[-1] + 1] = np.repeat(rising, lengths)
    # the run at the end is followed by the end, which is smaller than anything
    s[(differ[-1] + 1 if len(differ) else 0) : n - 1] = False
    return s


def _induce_bytes(t: np.ndarray, s: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """All suffixes in order, from the LMS suffixes in the order of ``lms``; t[-1] is a unique least symbol."""
    n = len(t)
    counts = np.bincount(t, minlength=size)
    ends = np.cumsum(counts)
    begins = ends - counts
    l_counts = np.bincount(t[~s], minlength=size)
    sa = np.full(n, -1, np.int64)
    by = np.argsort(t[lms], kind="stable")
    seeds, seed_counts = lms[by], np.bincount(t[lms], minlength=size)
    seed_ends = np.cumsum(seed_counts)
    head = begins.copy()

    def push(found: np.ndarray, up: bool, fill: np.ndarray) -> None:
        """Append suffixes to their buckets, those that come first nearest to the bucket's end they are filled from."""
        symbols = t[found]
        order = np.argsort(symbols, kind="stable")
        found, symbols = found[order], symbols[order]
        first = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        own = symbols[first]
        lengths = np.diff(np.r_[first, len(symbols)])
        rank = np.arange(len(symbols)) - np.repeat(first, lengths)
        if up:
            sa[np.repeat(fill[own], lengths) + rank] = found
            fill[own] += lengths
        else:
            sa[np.repeat(fill[own], lengths) - 1 - rank] = found
            fill[own] -= lengths

    for c in np.flatnonzero(counts):
        at = begins[c]
        while at < head[c]:
            stop = head[c]
            before = sa[at:stop] - 1
            before = before[before >= 0]
            before = before[~s[before]]
            if len(before):
                push(before, True, head)
            at = stop
        before = seeds[seed_ends[c] - seed_counts[c] : seed_ends[c]] - 1
        before = before[before >= 0]  # what precedes an LMS suffix is L
        if len(before):
            push(before, True, head)
    tail = ends.copy()
    for c in np.flatnonzero(counts)[::-1]:
        at = ends[c]
        while at > tail[c]:
            stop = tail[c]
            before = sa[stop:at][::-1] - 1
            before = before[before >= 0]
            before = before[s[before]]
            if len(before):
                push(before, False, tail)
            at = stop
        larger = sa[begins[c] : begins[c] + l_counts[c]][::-1] - 1
        larger = larger[larger >= 0]
        larger = larger[s[larger]]
        if len(larger):
            push(larger, False, tail)
    sa[0] = n - 1
    return sa


def _names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the LMS substrings in text order; ``ordered`` has the LMS places sorted by substring."""
    length = np.zeros(len(t), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    open_, k = np.flatnonzero(same), 0
    while len(open_):
        x, y = a[open_], b[open_]
        equal = t[x + k] == t[y + k]
        same[open_[~equal]] = False
        k += 1
        open_ = open_[equal]
        open_ = open_[length[a[open_]] > k]
    names = np.empty(len(t), np.int64)
    names[ordered] = np.cumsum(np.r_[0, ~same])
    return names[lms], int((~same).sum()) + 1


def _sais_names(t: np.ndarray, size: int) -> np.ndarray:
    """Suffix array of a string of names by induced sorting, step by step; t[-1] is a unique least name."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    s = _types(t)
    ends = np.cumsum(np.bincount(t, minlength=size))
    begins = np.r_[0, ends[:-1]].tolist()
    ends = ends.tolist()
    # the symbol before each place where that suffix is L, or S; -1 elsewhere and, at the end, for no place
    before = np.r_[-1, t[:-1], -1]
    l_before, s_before = before.copy(), before.copy()
    l_before[1:n][s[:-1]] = -1
    s_before[1:n][~s[:-1]] = -1
    l_before, s_before, symbol = l_before.tolist(), s_before.tolist(), t.tolist()

    def induce(lms: list[int]) -> list[int]:
        sa = [-1] * n
        fill = ends[:]
        for i in reversed(lms):
            c = symbol[i]
            fill[c] -= 1
            sa[fill[c]] = i
        fill = begins[:]
        for i in sa:  # the list fills ahead of the place that is read
            c = l_before[i]
            if c >= 0:
                sa[fill[c]] = i - 1
                fill[c] += 1
        fill = ends[:]
        for k in range(n - 1, -1, -1):
            i = sa[k]
            c = s_before[i]
            if c >= 0:
                fill[c] -= 1
                sa[fill[c]] = i - 1
        return sa

    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    if len(lms) > 1:
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = np.array(induce(lms.tolist()))
        ordered = order[is_lms[order]]
        named, made = _names(t, lms, ordered)
        lms = lms[_sais_names(named, made)] if made < len(lms) else ordered
    return np.array(induce(lms.tolist()))


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """Suffix array of ``text`` (symbols from 1 to ``size`` - 1), without the empty suffix."""
    t = np.r_[text.astype(np.int32), 0]
    n = len(t)
    if n == 1:
        return np.empty(0, np.int64)
    s = _types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    order = _induce_bytes(t, s, lms, size)
    if len(lms) > 1:
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ordered = order[is_lms[order]]
        named, made = _names(t, lms, ordered)
        ordered = lms[_sais_names(named, made)] if made < len(lms) else ordered
        order = _induce_bytes(t, s, ordered, size)
    return order[1:]


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every place: the suffix before it in order (-1: none), and the length of their common prefix.

    Where a place's left symbol equals that of the suffix before it, the length is one less than at
    the place to the left; only the other places are compared, eight bytes at a time.
    """
    n = len(text)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    places = np.arange(n)
    reduced = np.zeros(n, bool)
    inner = np.flatnonzero((places > 0) & (phi > 0))
    reduced[inner] = text[inner - 1] == text[phi[inner] - 1]
    base = np.flatnonzero(~reduced)
    length = np.zeros(len(base), np.int64)
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = text
    words = np.ndarray((n + 8,), "<u8", padded.tobytes(), 0, (1,))
    left, right = base, phi[base]
    going = np.flatnonzero(right >= 0)
    while len(going):
        at = length[going]
        room = n - np.maximum(left[going], right[going]) - at
        x, y = left[going] + at, right[going] + at
        same = (room >= 8) & (words[np.minimum(x, n)] == words[np.minimum(y, n)])
        rest = going[~same]
        if len(rest):
            i, j, room = x[~same], y[~same], np.minimum(room[~same], 8)
            matched, alive = np.zeros(len(rest), np.int64), np.ones(len(rest), bool)
            for k in range(8):
                alive &= (k < room) & (padded[i + k] == padded[j + k])
                matched += alive
            length[rest] += matched
        length[going[same]] += 8
        going = going[same]
    spread = np.zeros(n, np.int64)
    spread[base] = np.arange(len(base))
    of = np.maximum.accumulate(spread)
    return phi, np.where(phi >= 0, length[of] - (places - base[of]), 0)
