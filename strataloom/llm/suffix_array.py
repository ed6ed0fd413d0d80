"""Suffix arrays by induced sorting (Nong, Zhang and Chan 2009), linear in time at every level of the recursion.

Suffixes are classified, leftmost smaller (LMS) substrings are sorted by induction and named, the string of names is sorted
by the same algorithm, and its order induces the whole array. The two scans of an induction take a letter's bucket as a
block where letters are few, as in text: the suffixes before those of the block are split by type and appended to the
heads or tails of their buckets by one stable sort on the letter. In strings of names buckets are too small for that, and
the scans go suffix by suffix.
"""

from __future__ import annotations

import numpy as np

_FEW = 1024  # letters, up to which a block per bucket is quicker


def _types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S-type)."""
    n = len(s)
    step = np.sign(s[1:].astype(np.int64) - s[:-1])
    known = np.flatnonzero(step)
    following = np.searchsorted(known, np.arange(n - 1))
    out = np.ones(n, bool)
    has = following < len(known)
    out[:-1][has] = step[known[following[has]]] > 0
    return out


def _induce(s: np.ndarray, small: np.ndarray, starts: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Suffix array (or order of LMS substrings) induced from LMS suffixes in the order given, last letter first put."""
    n, k = len(s), len(starts) - 1
    sa = np.full(n, -1, np.int64)
    letters = s[lms]
    order = np.argsort(letters, kind="stable")
    counts = np.bincount(letters, minlength=k)
    first = starts[1:] - counts
    rank = np.arange(len(lms)) - np.repeat(np.cumsum(counts) - counts, counts)
    sa[first[letters[order]] + rank] = lms[order]
    head, tail = starts[:-1].copy(), starts[1:].copy()

    def put(before: np.ndarray, up: bool) -> None:
        c = s[before]
        if not up:
            before, c = before[::-1], c[::-1]  # so that a stable sort leaves what was scanned first nearest the tail
        order = np.argsort(c, kind="stable")
        c, before = c[order], before[order]
        counts = np.bincount(c, minlength=k)
        rank = np.arange(len(c)) - np.repeat(np.cumsum(counts) - counts, counts)
        if up:
            sa[head[c] + rank] = before
            np.add(head, counts, out=head)
        else:
            np.subtract(tail, counts, out=tail)
            sa[tail[c] + rank] = before

    for c in range(k):  # larger suffixes (L-type), left to right
        at, done = starts[c], False
        while not done:
            end = head[c]
            block = sa[at:end] if at < end else sa[max(first[c], end) : starts[c + 1]]
            done = at >= end
            at = end
            before = block[block > 0] - 1
            before = before[~small[before]]
            if len(before):
                put(before, True)
            if done:
                break
    for c in range(k):  # only the larger ones stay, for the smaller are now put in order
        sa[head[c] : starts[c + 1]] = -1
    for c in range(k - 1, -1, -1):  # smaller suffixes (S-type), right to left
        at, done = starts[c + 1], False
        while not done:
            end = tail[c]
            block = sa[end:at] if end < at else sa[starts[c] : head[c]]
            done = end >= at
            at = end
            before = block[::-1]
            before = before[before > 0] - 1
            before = before[small[before]]
            if len(before):
                put(before, False)
            if done:
                break
    sa[0] = n - 1
    return sa


def _induce_each(s: np.ndarray, small: np.ndarray, starts: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The same by suffix."""
    sa, letter, is_small = [-1] * len(s), s.tolist(), small.tolist()
    tail = starts[1:].tolist()
    for i in lms[::-1].tolist():
        c = letter[i]
        tail[c] -= 1
        sa[tail[c]] = i
    head = starts[:-1].tolist()
    for at in sa:  # filled on the way: what is put lies ahead
        i = at - 1
        if i >= 0 and not is_small[i]:
            c = letter[i]
            sa[head[c]] = i
            head[c] += 1
    tail = starts[1:].tolist()
    for j in range(len(sa) - 1, -1, -1):
        i = sa[j] - 1
        if i >= 0 and is_small[i]:
            c = letter[i]
            tail[c] -= 1
            sa[tail[c]] = i
    sa[0] = len(s) - 1
    return np.array(sa, np.int64)


def _name(s: np.ndarray, lms: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the LMS substrings in text order (equal substrings, equal names), and their number."""
    size = np.diff(np.append(lms, len(s)))
    size[:-1] += 1  # an LMS substring ends with the next LMS letter
    rank_of = np.empty(len(s), np.int64)
    rank_of[lms] = np.arange(len(lms))
    at = rank_of[order]
    a, b = lms[at[:-1]], lms[at[1:]]
    differ = size[at[:-1]] != size[at[1:]]
    active, depth = np.flatnonzero(~differ), 0
    length = size[at[1:]]
    while len(active):
        unequal = s[a[active] + depth] != s[b[active] + depth]
        differ[active[unequal]] = True
        depth += 1
        active = active[~unequal]
        active = active[length[active] > depth]
    names = np.empty(len(lms), np.int64)
    names[at] = np.concatenate([[0], np.cumsum(differ)])
    return names, int(differ.sum()) + 1


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of integers >= 0 whose last one is 0 and the only 0."""
    n = len(s)
    k = int(s.max(initial=0)) + 1
    if n < 3:
        return np.arange(n - 1, -1, -1)
    induce = _induce if k <= _FEW else _induce_each
    s = s.astype(np.int16 if k < 2**15 else np.int32 if k < 2**31 else np.int64)
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    starts = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=k))])
    sa = induce(s, small, starts, lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    names, distinct = _name(s, lms, order)
    if distinct < len(lms):
        order = lms[suffix_array(names)]
    return induce(s, small, starts, order)


def _words(s: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one integer (zeros past the end)."""
    padded = np.concatenate([s.astype(np.uint8), np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(s)]


def permuted_lcp(s: np.ndarray, sa: np.ndarray, cap: int, every: int = 8) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the array, in text order, exact up to ``cap``.

    It falls by at most one per place, so every eighth place is compared from scratch and the rest from that bound on.
    """
    n = len(s)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    lcp = np.zeros(n, np.int64)
    text = np.concatenate([s, -1 - np.arange(cap + 8)])  # what lies past the end equals nothing

    def compare(at: np.ndarray, depth: np.ndarray) -> None:
        ok = before[at] >= 0
        at, depth = at[ok], depth[ok]
        while len(at):
            x, y = at + depth, before[at] + depth
            inside = (x + 8 <= n) & (y + 8 <= n) & (depth + 8 <= cap)
            eight = np.zeros(len(at), bool)
            if inside.any():
                eight[inside] = packed[x[inside]] == packed[y[inside]]
            one = ~eight & (text[np.minimum(x, len(text) - 1)] == text[np.minimum(y, len(text) - 1)]) & (x != y) & (x < n) & (y < n)
            depth = depth + np.where(eight, 8, np.where(one, 1, 0))
            over = ~(eight | one) | (depth >= cap)
            lcp[at[over]] = np.minimum(depth[over], cap)
            at, depth = at[~over], depth[~over]

    low = np.concatenate([s.astype(np.uint64) & np.uint64(0xFF), np.zeros(8, np.uint64)])
    high = np.concatenate([(s >= 256).astype(np.uint64), np.zeros(8, np.uint64)])
    packed = np.zeros(n, np.uint64)
    for i in range(8):
        packed |= low[i : i + n] << np.uint64(8 * i)
    if high.any():  # a letter past one byte makes its window unique, so it is compared letter by letter
        cum = np.concatenate([[0], np.cumsum(high)])
        odd = cum[8 : n + 8] - cum[:n] > 0
        packed[odd] = (np.arange(n, dtype=np.uint64) | np.uint64(1 << 63))[odd]
    compare(np.arange(0, n, every), np.zeros(len(range(0, n, every)), np.int64))
    rest = np.flatnonzero(np.arange(n) % every)
    compare(rest, np.maximum(lcp[rest - rest % every] - rest % every, 0))
    return lcp
