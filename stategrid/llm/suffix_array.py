"""Suffix arrays by induced sorting, and permuted common prefixes.

Everything is numpy on whole buckets: the induction goes bucket by bucket, and
inside a bucket in rounds for runs of one symbol.
"""

from __future__ import annotations

import numpy as np

#: Alphabet of a reduced string up to which it is sorted by the same induction; a larger one is
#: nearly all different symbols and is sorted by doubling of its ranks.
LOOP = 1024


def types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S type)."""
    rise = np.sign(s[1:].astype(np.int64) - s[:-1])
    at = np.where(rise != 0, np.arange(len(rise)), len(rise) - 1)
    following = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(rise[following] > 0, True)


def _push(sa: np.ndarray, ptr: np.ndarray, s: np.ndarray, j: np.ndarray, step: int) -> None:
    """Appends the suffixes j, in order, to their symbols' buckets: upwards
    from ptr (step 1) or downwards below ptr (step -1)."""
    if not len(j):
        return
    keys = s[j]
    order = np.argsort(keys, kind="stable")
    j, keys = j[order], keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.append(first, len(j)))
    rank = np.arange(len(j)) - np.repeat(first, size)
    base = np.repeat(ptr[keys[first]], size)
    sa[base + rank if step > 0 else base - 1 - rank] = j
    ptr[keys[first]] += step * size


def induce(s: np.ndarray, k: int, lms: np.ndarray) -> np.ndarray:
    """All suffixes, given the leftmost-smaller ones in order (by their first
    symbols at least)."""
    n = len(s)
    count = np.bincount(s, minlength=k)
    end = np.cumsum(count)
    start = end - count
    sa = np.full(n, -1, np.int32)
    small = np.bincount(s[lms], minlength=k)
    below = end - small
    keys = s[lms]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    rank = np.arange(len(lms)) - np.repeat(first, np.diff(np.append(first, len(lms))))
    sa[below[keys] + rank] = lms
    ptr = start.copy()
    used = np.flatnonzero(count)
    for c in used.tolist():
        done, later = start[c], []
        while done < ptr[c]:
            j = sa[done:ptr[c]] - 1
            done = ptr[c]
            j = j[j >= 0]
            sym = s[j]
            same = j[sym == c]
            sa[ptr[c]:ptr[c] + len(same)] = same
            ptr[c] += len(same)
            later.append(j[sym > c])
        j = sa[below[c]:end[c]] - 1
        later.append(j[j >= 0])
        _push(sa, ptr, s, np.concatenate(later), 1)
    larger = ptr - start                # L suffixes of each bucket
    ptr = end.copy()
    ptr[0] = 0                          # the sentinel stays
    for c in used[::-1].tolist():
        done, later = end[c], []
        while ptr[c] < done:
            j = sa[ptr[c]:done][::-1] - 1
            done = ptr[c]
            j = j[j >= 0]
            sym = s[j]
            same = j[sym == c]
            sa[ptr[c] - len(same):ptr[c]] = same[::-1]
            ptr[c] -= len(same)
            later.append(j[sym < c])
        if larger[c]:
            j = sa[start[c]:start[c] + larger[c]][::-1] - 1
            j = j[j >= 0]
            later.append(j[s[j] < c])
        if later:
            _push(sa, ptr, s, np.concatenate(later), -1)
    return sa


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings in ``ordered``, equal ones alike."""
    size = np.zeros(len(s), np.int32)
    size[lms] = np.append(np.diff(lms) + 1, 1)
    a, b = ordered[:-1], ordered[1:]
    new = size[a] != size[b]
    left = np.flatnonzero(~new)
    k = 0
    while len(left):
        same = s[a[left] + k] == s[b[left] + k]
        new[left[~same]] = True
        left = left[same]
        k += 1
        left = left[size[a[left]] > k]
    return np.concatenate(([0], np.cumsum(new)))


def _doubled(s: np.ndarray) -> np.ndarray:
    """By doubling: ranks by 1, 2, 4 ... symbols; only ties are sorted again."""
    n = len(s)
    order = np.argsort(s, kind="stable")
    new = np.concatenate(([True], s[order][1:] != s[order][:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    place, h = np.arange(n), 1          # places of the order whose suffixes are tied
    while True:
        alone = new[place] & np.append(new, True)[place + 1]
        place = place[~alone]
        if not len(place):
            return order
        tied = order[place]
        ahead = np.where(tied + h < n, rank[np.minimum(tied + h, n - 1)] + 1, 0)
        key = rank[tied] * (n + 2) + ahead
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        order[place] = tied
        new[place] = np.concatenate(([True], key[1:] != key[:-1]))
        rank[tied] = np.maximum.accumulate(np.where(new[place], place, 0))
        h *= 2


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of symbols 0..k-1; the last symbol is 0 and the only 0.
    16-bit symbols sort fastest."""
    if len(s) < 3:
        return np.arange(len(s))[::-1].astype(np.int32)
    rising = types(s)
    lms = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    sa = induce(s, k, lms[np.argsort(s[lms], kind="stable")])
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    ordered = sa[is_lms[sa]]
    names = _names(s, lms, ordered)
    del is_lms, sa
    if names[-1] < len(lms) - 1:
        named = np.empty(len(s), np.int64)
        named[ordered] = names
        reduced = named[lms]
        if names[-1] < 1 << 16:
            reduced = reduced.astype(np.uint16)
        order = suffix_array(reduced, int(names[-1]) + 1) if names[-1] < LOOP else _doubled(reduced)
        ordered = lms[order]
    return induce(s, k, ordered)


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Of each place, the symbols that its suffix shares with the suffix before
    it in ``sa`` (permuted order). A place whose suffix continues the match of
    the place before it needs no comparison: it shares one symbol less."""
    n = len(text)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    place = np.arange(n)
    first = (phi <= 0) | (place == 0)
    inner = np.flatnonzero(~first)
    first[inner] = text[inner - 1] != text[phi[inner] - 1]
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.ndarray((n,), "<u8", padded, 0, (1,))
    shared = np.zeros(n, np.int64)
    live = np.flatnonzero(first & (phi >= 0))
    at = np.zeros(len(live), np.int64)
    while len(live):
        a, b = live + at, phi[live] + at
        inside = np.maximum(a, b) < n
        diff = np.where(inside, words[np.minimum(a, n - 1)] ^ words[np.minimum(b, n - 1)],
                        np.uint64(1))
        low = diff & (~diff + np.uint64(1))         # lowest differing bit
        equal = diff == 0
        bytes_ = np.zeros(len(live), np.int64)
        stop = ~equal
        bytes_[stop] = (np.log2(low[stop].astype(np.float64)) // 8).astype(np.int64)
        shared[live[stop]] = np.minimum(at[stop] + bytes_[stop],
                                        n - np.maximum(live[stop], phi[live[stop]]))
        live, at = live[equal], at[equal] + 8
    last = np.maximum.accumulate(np.where(first, place, 0))
    return np.maximum(0, shared[last] - (place - last))
