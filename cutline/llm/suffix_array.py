"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified as smaller (S) or larger (L) than the next one. The leftmost S of a run is LMS. LMS substrings are
sorted by one round of induction, named, and the string of names, at most half as long, is sorted by the same function; from the
sorted LMS suffixes a second round induces the whole array. Bytes are induced bucket by bucket, each in a few array operations;
strings of names have about as many buckets as characters and are induced one by one.
"""

from __future__ import annotations

import numpy as np

BUCKETS = 256  # alphabets up to this size are induced by buckets


def _types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the empty suffix at the end is the smallest of all."""
    n = len(s)
    out = np.zeros(n, bool)
    if n > 1:
        differ = np.flatnonzero(s[1:] != s[:-1])  # the type of i is that of the next i where s[i] and s[i + 1] differ
        if len(differ):
            rises = s[differ] < s[differ + 1]
            out[: differ[-1] + 1] = np.repeat(rises, np.diff(np.concatenate([[-1], differ])))
    return out


def _by_buckets(s: np.ndarray, small: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """Order of all suffixes that the order of ``lms`` induces."""
    n, counts = len(s), np.bincount(s, minlength=sigma)
    ends = np.cumsum(counts)
    starts = ends - counts
    sa = np.full(n, -1, np.int64)
    first = s[lms]
    marks = np.bincount(first, minlength=sigma)
    if len(lms):
        order = np.argsort(first, kind="stable")
        rank = np.arange(len(lms)) - np.repeat(np.cumsum(marks) - marks, marks)
        sa[np.repeat(ends - marks, marks) + rank] = lms[order]

    def placed(j: np.ndarray, at: np.ndarray, step: int) -> None:
        c = s[j]
        order = np.argsort(c, kind="stable")
        c, j = c[order], j[order]
        new = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        size = np.diff(np.append(new, len(c)))
        rank = np.arange(len(c)) - np.repeat(new, size)
        keys = c[new]
        sa[np.repeat(at[keys], size) + step * rank] = j
        at[keys] += step * size

    heads = starts.copy()
    placed(np.array([n - 1]), heads, 1)  # the last suffix is an L
    for c in np.flatnonzero(counts).tolist():
        lo, hi = starts[c], heads[c]
        while lo < hi:
            j = sa[lo:hi] - 1
            j = j[j >= 0]
            j = j[~small[j]]
            if len(j):
                placed(j, heads, 1)
            lo, hi = hi, heads[c]
        if marks[c]:
            j = sa[ends[c] - marks[c] : ends[c]] - 1
            j = j[j >= 0]
            placed(j[~small[j]], heads, 1) if len(j) else None
    tails = ends - 1
    for c in np.flatnonzero(counts)[::-1].tolist():
        hi, lo = ends[c] - 1, tails[c]
        while lo < hi:
            j = sa[lo + 1 : hi + 1][::-1] - 1
            j = j[j >= 0]
            j = j[small[j]]
            if len(j):
                placed(j, tails, -1)
            hi, lo = lo, tails[c]
        j = sa[starts[c] : heads[c]][::-1] - 1
        j = j[j >= 0]
        j = j[small[j]]
        if len(j):
            placed(j, tails, -1)
    return sa


def _one_by_one(s: np.ndarray, small: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    n, counts = len(s), np.bincount(s, minlength=sigma)
    ends = np.cumsum(counts)
    heads, tails = (ends - counts).tolist(), ends.tolist()
    chars, is_small, sa = s.tolist(), small.tolist(), [-1] * n
    for p in lms[::-1].tolist():
        c = chars[p]
        tails[c] -= 1
        sa[tails[c]] = p
    c = chars[n - 1]
    sa[heads[c]] = n - 1
    heads[c] += 1
    for i in range(n):
        j = sa[i] - 1
        if j >= 0 and not is_small[j]:
            c = chars[j]
            sa[heads[c]] = j
            heads[c] += 1
    tails = ends.tolist()
    for i in range(n - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and is_small[j]:
            c = chars[j]
            tails[c] -= 1
            sa[tails[c]] = j
    return np.array(sa, np.int64)


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Name of each LMS substring, in text order: the rank among the different ones."""
    n = len(s)
    after = np.full(n, n, np.int64)  # one beyond the substring, which ends with the first character of the next one
    after[lms[:-1]] = lms[1:] + 1
    a, b = ordered[:-1], ordered[1:]
    differ = after[a] - a != after[b] - b
    differ |= (after[a] == n) | (after[b] == n)  # the last one ends with the empty suffix, as no other does
    live, k = np.flatnonzero(~differ), 0
    while len(live):
        same = s[a[live] + k] == s[b[live] + k]
        differ[live[~same]] = True
        k += 1
        live = live[same]
        live = live[a[live] + k < after[a[live]]]
    name = np.concatenate([[0], np.cumsum(differ)])
    out = np.zeros(n, np.int64)
    out[ordered] = name
    return out[lms], int(name[-1]) + 1


def suffix_array(s: np.ndarray, sigma: int = 256) -> np.ndarray:
    """Start of every suffix of ``s`` (characters 0 to sigma - 1) in ascending order; a prefix comes before what it begins."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    s = s.astype(np.uint8 if sigma <= 256 else np.int64, copy=False)
    induce = _by_buckets if sigma <= BUCKETS and n > 16 * sigma else _one_by_one
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sa = induce(s, small, lms, sigma)
    if len(lms) < 2:
        return sa
    marked = np.zeros(n, bool)
    marked[lms] = True
    names, count = _names(s, lms, sa[marked[sa]])
    if count == len(lms):
        order = np.empty(len(lms), np.int64)
        order[names] = np.arange(len(lms))
    else:
        order = suffix_array(names, count)
    return induce(s, small, lms[order], sigma)


def permuted_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, the length of the prefix its suffix shares with the one before it in the array (0 for the first).

    Where the characters before both are equal, the value is that of the position before, less one. Only the other positions
    compare characters; their sum is bounded by n log n.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    fresh = np.ones(n, bool)
    held = np.flatnonzero(before[1:] > 0) + 1
    fresh[held] = s[held - 1] != s[before[held] - 1]
    starts = np.flatnonzero(fresh)
    length = np.zeros(len(starts), np.int64)
    live = np.flatnonzero(before[starts] >= 0)
    i, j = starts[live], before[starts[live]]
    k = 0
    while len(live):
        inside = np.maximum(i, j) + k < n
        live, i, j = live[inside], i[inside], j[inside]
        same = s[i + k] == s[j + k]
        length[live[~same]] = k
        live, i, j = live[same], i[same], j[same]
        k += 1
        length[live] = k
    size = np.diff(np.append(starts, n))
    return np.repeat(length + starts, size) - np.arange(n)
