"""Suffix arrays by induced sorting, and permuted longest common prefixes, on whole numpy arrays.

Suffixes are classified as smaller or larger than their right neighbour. Sorted leftmost-smaller
(LMS) suffixes induce all larger ones from the left and then all smaller ones from the right. A
bucket (suffixes with the same first symbol) is induced in one array step per round; a round more
is needed only for runs of the bucket's own symbol. The LMS order comes from naming the sorted LMS
substrings and recursion on the string of names, down to names that are all different. Where buckets
are thin, as those of many names are, or runs are long, an array step costs more than the few symbols
it moves, and suffixes are induced one by one. Work is linear in the text.
"""

from __future__ import annotations

import numpy as np

THIN_BUCKET = 100  # symbols per array step below which they are induced one by one


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of a uint8 array in lexical order."""
    if not len(text):
        return np.empty(0, np.int64)
    s = np.zeros(len(text) + 1, np.uint16)
    s[:-1] = text
    s[:-1] += 1
    return _sort(s, 257)[1:]


def _smaller(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the end is."""
    change = np.flatnonzero(s[1:] != s[:-1])
    kinds = np.append(s[change] < s[change + 1], True)
    return np.repeat(kinds, np.diff(np.concatenate([[-1], change, [len(s) - 1]])))


def _sort(s: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of ``s``, which ends in a unique smallest 0."""
    if len(s) == 1:
        return np.zeros(1, np.int64)
    small = _smaller(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    first = _induce(s, small, lms[np.argsort(s[lms], kind="stable")], symbols)
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    ordered = first[is_lms[first]]
    names = _names(s, lms, ordered)
    distinct = int(names[-1]) + 1
    if distinct == len(lms):
        return _induce(s, small, ordered, symbols)
    place = np.empty(len(s), np.int64)
    place[ordered] = names
    reduced = place[lms]
    kind = np.uint16 if distinct <= 1 << 16 else np.int64
    order = _sort(reduced.astype(kind), distinct)
    return _induce(s, small, lms[order], symbols)


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Numbers of the LMS substrings in their order; equal ones share a number."""
    length = np.zeros(len(s), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    sizes = length[a]
    same = sizes == length[b]
    active, k = np.flatnonzero(same), 0
    while len(active):
        equal = s[a[active] + k] == s[b[active] + k]
        same[active[~equal]] = False
        k += 1
        active = active[equal]
        active = active[sizes[active] > k]
    return np.concatenate([[0], np.cumsum(~same)])


def _rounds(s: np.ndarray, symbols: int) -> int:
    """Array steps that inducing takes at most: a symbol's longest run, summed over the symbols."""
    last = np.flatnonzero(np.append(s[1:] != s[:-1], True))
    longest = np.zeros(symbols, np.int64)
    np.maximum.at(longest, s[last], np.diff(last, prepend=-1))
    return int(longest.sum())


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes in order, from LMS suffixes in the order given."""
    counts = np.bincount(s, minlength=symbols)
    ends = np.cumsum(counts)
    if _rounds(s, symbols) * THIN_BUCKET > len(s):
        return _induce_singly(s, small, lms, ends, counts)
    starts = ends - counts
    sa = np.full(len(s), -1, np.int64)
    lms_symbols = s[lms]
    lms_counts = np.bincount(lms_symbols, minlength=symbols)
    lms_starts = np.cumsum(lms_counts) - lms_counts

    heads, used = starts.copy(), np.flatnonzero(counts)

    def put(p: np.ndarray, pointers: np.ndarray, step: int) -> None:
        """Append positions to their buckets in the given order, upwards or downwards."""
        v = s[p]
        order = np.argsort(v, kind="stable")
        v = v[order]
        new = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
        sizes = np.diff(np.append(new, len(v)))
        keys = v[new]
        rank = np.arange(len(v)) - np.repeat(new, sizes)
        if step > 0:
            sa[np.repeat(pointers[keys], sizes) + rank] = p[order]
        else:
            sa[np.repeat(pointers[keys], sizes) - 1 - rank] = p[order]
        pointers[keys] += step * sizes

    for c in used.tolist():
        low = starts[c]
        while low < heads[c]:
            p = sa[low : heads[c]] - 1
            low = heads[c]
            p = p[p >= 0]
            p = p[~small[p]]
            if len(p):
                put(p, heads, 1)
        seeds = lms[lms_starts[c] : lms_starts[c] + lms_counts[c]] - 1
        if len(seeds):
            put(seeds, heads, 1)

    tails = ends.copy()
    sa[0] = len(s) - 1
    for c in used[::-1].tolist():
        high = ends[c]
        while high > tails[c]:
            p = sa[tails[c] : high][::-1] - 1
            high = tails[c]
            p = p[p >= 0]
            p = p[small[p]]
            if len(p):
                put(p, tails, -1)
        p = sa[starts[c] : heads[c]][::-1] - 1
        p = p[p >= 0]
        p = p[small[p]]
        if len(p):
            put(p, tails, -1)
    return sa


def _induce_singly(
    s: np.ndarray, small: np.ndarray, lms: np.ndarray, ends: np.ndarray, counts: np.ndarray
) -> np.ndarray:
    """What ``_induce`` gives, suffix by suffix.

    0 stands for a place not yet filled: like suffix 0 itself it induces nothing, as what lies before
    it, the end of ``s``, counts as neither larger nor smaller.
    """
    wide = s.astype(np.int64)
    larger = np.where(small, -1, wide).tolist()
    smaller = np.where(small, wide, -1)
    smaller[-1] = -1
    smaller = smaller.tolist()

    seeds = s[lms]
    grouped = np.argsort(seeds, kind="stable")
    sizes = np.bincount(seeds, minlength=len(ends))
    behind = np.arange(len(lms)) - np.cumsum(sizes)[seeds[grouped]]
    filled = np.zeros(len(s), np.int64)
    filled[ends[seeds[grouped]] + behind] = lms[grouped]
    sa, heads, tails = filled.tolist(), (ends - counts).tolist(), ends.tolist()

    for p in sa:  # sees what it fills further on
        c = larger[p - 1]
        if c >= 0:
            sa[heads[c]] = p - 1
            heads[c] += 1
    for p in reversed(sa):
        c = smaller[p - 1]
        if c >= 0:
            tails[c] -= 1
            sa[tails[c]] = p - 1
    return np.array(sa, np.int64)


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(before, plcp): each suffix's predecessor in the array (-1: none) and the length of their
    common prefix, both in text order.

    A value is one less than its left neighbour's unless the two suffixes are preceded by
    different bytes; only at such places bytes are compared, eight at a time.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    known = (before > 0) & (at > 0)
    same = np.zeros(n, bool)
    p = np.flatnonzero(known)
    same[p] = text[p - 1] == text[before[p] - 1]
    places = np.flatnonzero(~same)
    there = places[before[places] >= 0]
    length = np.zeros(n, np.int64)

    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = text
    eight = np.lib.stride_tricks.as_strided(padded, (n + 1, 8), (1, 1))
    words = np.ascontiguousarray(eight).view(np.uint64).reshape(-1) if n else np.empty(0, np.uint64)
    other = before[there]
    limit = n - np.maximum(there, other)
    matched = np.zeros(len(there), np.int64)
    active = np.arange(len(there))
    while len(active):
        x = words[there[active] + matched[active]] ^ words[other[active] + matched[active]]
        differ = x != 0
        done = active[differ]
        low = x[differ] & (~x[differ] + np.uint64(1))
        matched[done] += np.log2(low.astype(np.float64)).astype(np.int64) // 8
        active = active[~differ]
        matched[active] += 8
        active = active[matched[active] < limit[active]]
    length[there] = np.minimum(matched, limit)
    base = np.zeros(n, np.int64)
    base[places] = places
    base = np.maximum.accumulate(base)
    return before, length[base] - (at - base)
