"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

The classic linear scheme: suffixes are classified as smaller or larger than
their successor; substrings between leftmost smaller positions are sorted by
inducing, named, and the string of names is sorted recursively; inducing
from the sorted leftmost smaller suffixes then places all others. Inducing
runs bucket by bucket; within a bucket whole waves of entries are handled at
once, so Python's part is proportional to the alphabet and not the text.
Names, which can be many, are written as digits for the recursion, so the
alphabet stays small; the string still shrinks by a third each time. Short
strings of names end the recursion: they are ordered by doubling.
"""

from __future__ import annotations

import numpy as np

from quarry.llm.vec import mix, powers

#: Reduced strings with at most this many names keep them as symbols.
MAX_ALPHABET = 1 << 9
#: Strings of at most this many names are ordered without recursion.
SHORT = 1 << 20


def _deal(sa: np.ndarray, ptr: np.ndarray, s: np.ndarray, at: np.ndarray, down: bool) -> None:
    """Put suffixes ``at``, in order, at the next free places of their buckets."""
    ch = s[at]
    order = np.argsort(ch, kind="stable")
    at, ch = at[order], ch[order]
    count = np.bincount(ch, minlength=len(ptr))
    within = np.arange(len(at), dtype=np.int64)
    if down:
        sa[(ptr + np.cumsum(count) - count)[ch] - within] = at
        ptr -= count
    else:
        sa[(ptr - np.cumsum(count) + count)[ch] + within] = at
        ptr += count


def _induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """Suffix array induced from leftmost smaller suffixes in their order."""
    n = len(s)
    size = np.bincount(s, minlength=k)
    end = np.cumsum(size)
    head, tail = end - size, end - 1
    sa = np.full(n, -1, np.int32)
    seeds = np.bincount(s[lms], minlength=k)
    ptr = tail.copy()
    _deal(sa, ptr, s, lms[::-1], True)
    used = np.flatnonzero(size)
    front = head.copy()
    for c in used:
        at = head[c]
        while at < front[c]:  # larger suffixes of the bucket, a wave at a time
            wave = sa[at:front[c]] - 1
            at = front[c]
            wave = wave[wave >= 0]
            wave = wave[~smaller[wave]]
            if len(wave):
                _deal(sa, front, s, wave, False)
        if seeds[c]:
            wave = sa[end[c] - seeds[c]:end[c]] - 1
            wave = wave[wave >= 0]
            wave = wave[~smaller[wave]]
            if len(wave):
                _deal(sa, front, s, wave, False)
    back = tail.copy()
    for c in used[::-1]:
        at = tail[c]
        while at > back[c]:  # smaller suffixes, from the right
            wave = sa[back[c] + 1:at + 1][::-1] - 1
            at = back[c]
            wave = wave[wave >= 0]
            wave = wave[smaller[wave]]
            if len(wave):
                _deal(sa, back, s, wave, True)
        if front[c] > head[c]:
            wave = sa[head[c]:front[c]][::-1] - 1
            wave = wave[wave >= 0]
            wave = wave[smaller[wave]]
            if len(wave):
                _deal(sa, back, s, wave, True)
    return sa


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last one is."""
    n = len(s)
    step = np.ones(n, np.int8)
    np.sign(s[1:].astype(np.int32) - s[:-1].astype(np.int32), out=step[:-1], casting="unsafe")
    decided = np.where(step != 0, np.arange(n), n)
    nearest = np.minimum.accumulate(decided[::-1])[::-1]  # equal symbols go as the first that differs
    return step[nearest] > 0


def suffix_array(s: np.ndarray, k: int, depth: int | None = None) -> np.ndarray:
    """Suffix array of ``s``, symbols 0 to k - 1, whose last one is 0 and
    occurs nowhere else. With ``depth``, suffixes that agree on that many
    symbols may stand in any order."""
    n = len(s)
    s = s.astype(np.uint16) if k <= 1 << 16 else s
    if n == 1:
        return np.zeros(1, np.int32)
    smaller = _types(s)
    leftmost = smaller.copy()
    leftmost[1:] &= ~smaller[:-1]
    leftmost[0] = False
    lms = np.flatnonzero(leftmost).astype(np.int32)
    if len(lms) > 1:
        # order and name the substrings from one leftmost smaller place to the next
        sa = _induce(s, smaller, lms, k)
        by_rank = sa[leftmost[sa]]
        del sa
        p, q = powers(n + 1)
        h = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(np.arange(k, dtype=np.uint64) + np.uint64(977))[s] * p[:-1], out=h[1:])
        following = np.zeros(n, np.int32)
        following[lms[:-1]] = lms[1:]
        following[lms[-1]] = n - 1
        stop = following[by_rank].astype(np.int64) + 1
        name = mix((h[stop] - h[by_rank]) * q[by_rank]) + (stop - by_rank).astype(np.uint64)
        new = np.ones(len(by_rank), bool)
        new[1:] = name[1:] != name[:-1]
        rank = np.empty(n, np.int64)
        rank[by_rank] = np.cumsum(new) - 1
        names = rank[lms]
        count = int(names.max()) + 1
        if count == len(lms):
            lms = by_rank
        else:
            lms = lms[_order(names, count, depth)]
    return _induce(s, smaller, lms, k)


def _order(names: np.ndarray, count: int, depth: int | None) -> np.ndarray:
    """Order of the suffixes of the string of names (its last name, 0, is
    unique; a name stands for at least one symbol)."""
    if len(names) <= SHORT:
        return _by_doubling(names, depth)
    if count <= MAX_ALPHABET:
        return suffix_array(names, count, depth)
    base = int(np.ceil(np.sqrt(count))) + 1
    digits = np.empty(2 * len(names) + 1, np.int32)
    digits[0:-1:2] = names // base + 1
    digits[1:-1:2] = names % base + 1
    digits[-1] = 0
    sa = suffix_array(digits, base + 2, depth and 2 * depth)
    return sa[(sa % 2 == 0) & (sa < len(digits) - 1)] // 2


def _by_doubling(names: np.ndarray, depth: int | None) -> np.ndarray:
    """Ranks of twice as many names each time, until all differ (or depth)."""
    n = len(names)
    rank, reach = names.astype(np.int64), 1
    while True:
        key = rank * (n + 1)
        key[:n - reach] += rank[reach:] + 1
        order = np.argsort(key)
        key = key[order]
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        rank[order] = np.cumsum(new) - 1
        reach *= 2
        if new.all() or reach >= n or (depth and reach >= depth):
            return order


def common_prefixes(s: np.ndarray, sa: np.ndarray, most: int, places: np.ndarray | None = None,
                    exact: bool = True) -> np.ndarray:
    """For each place of the text (or each of ``places``), the length,
    ``most`` at most, that its suffix has in common with the one before it in
    the array: the permuted common prefixes, all places at once, by halving
    steps on span hashes. Without ``exact``, lengths below ``most`` are 0."""
    n = len(s)
    before = np.zeros(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = n
    p, q = powers(n + 1)
    h = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(np.arange(int(s.max(initial=0)) + 1, dtype=np.uint64) + np.uint64(977))[s] * p[:-1], out=h[1:])
    a = np.arange(n) if places is None else places.astype(np.int64)
    b = before[a]
    out = np.zeros(len(a), np.int64)
    step = 1 << (int(most).bit_length() - 1) if exact else most
    while step:
        ok = np.flatnonzero((out + step <= most) & (np.maximum(a, b) + step <= n))
        x, y = a[ok], b[ok]
        same = ok[(h[x + step] - h[x]) * q[x] == (h[y + step] - h[y]) * q[y]]
        out[same] += step
        a[same] += step
        b[same] += step
        step = step // 2 if exact else 0
    return out
