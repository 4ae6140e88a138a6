"""Suffix arrays by induced sorting, and permuted common prefixes.

Over bytes induction runs bucket by bucket in numpy: all suffixes of a bucket that are known induce their predecessors
at once, in the order in which a scan would meet them. Names of the recursion have many buckets of a few suffixes each:
there the scan goes suffix by suffix.
"""

from __future__ import annotations

import numpy as np

def smaller_types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last symbol is the only smallest one."""
    n = len(t)
    s = np.ones(n, bool)
    if n > 1:
        turn = np.where(t[:-1] != t[1:], np.arange(n - 1), n)
        turn = np.minimum.accumulate(turn[::-1])[::-1]
        s[:-1] = t[turn] < t[turn + 1]
    return s


def induce(t: np.ndarray, s: np.ndarray, leftmost: np.ndarray, k: int) -> np.ndarray:
    """All suffixes from an order of the leftmost-smaller ones: larger ones from the left, smaller ones from the right."""
    n = len(t)
    count = np.bincount(t, minlength=k)
    end = np.cumsum(count)
    start = end - count
    larger = np.bincount(t[~s], minlength=k)
    sa = np.full(n, -1, np.int64)

    def deal(p: np.ndarray):
        """Stable by symbol: suffixes, their symbols, their rank within a symbol, and the symbols' counts."""
        c = t[p]
        order = np.argsort(c, kind="stable")
        p, c = p[order], c[order]
        many = np.bincount(c, minlength=k)
        return p, c, np.arange(len(p)) - (np.cumsum(many) - many)[c], many

    p, c, rank, seeds = deal(leftmost)
    sa[(end - seeds)[c] + rank] = p
    present = np.flatnonzero(count)

    head = start.copy()
    for b in present:
        at = start[b]
        while at < head[b]:
            to = head[b]
            p = sa[at:to] - 1
            p = p[p >= 0]
            p = p[~s[p]]
            at = to
            if len(p):
                p, c, rank, many = deal(p)
                sa[head[c] + rank] = p
                head += many
        p = sa[end[b] - seeds[b] : end[b]] - 1
        p = p[p >= 0]
        p = p[~s[p]]
        if len(p):
            p, c, rank, many = deal(p)
            sa[head[c] + rank] = p
            head += many

    tail = end.copy()
    sa[0], tail[0] = n - 1, 0
    for b in present[::-1]:
        to = end[b]
        while to > tail[b]:
            at = tail[b]
            p = sa[at:to][::-1] - 1
            p = p[p >= 0]
            p = p[s[p]]
            to = at
            if len(p):
                p, c, rank, many = deal(p)
                sa[tail[c] - 1 - rank] = p
                tail -= many
        p = sa[start[b] : start[b] + larger[b]][::-1] - 1
        p = p[p >= 0]
        p = p[s[p]]
        if len(p):
            p, c, rank, many = deal(p)
            sa[tail[c] - 1 - rank] = p
            tail -= many
    return sa


def induce_by_scan(t: np.ndarray, s: np.ndarray, leftmost: np.ndarray, k: int) -> np.ndarray:
    """The same for any alphabet, in time linear in the symbols and k."""
    n = len(t)
    end = np.cumsum(np.bincount(t, minlength=k))
    heads, tails = np.concatenate([[0], end[:-1]]).tolist(), end.tolist()
    symbol, small = t.tolist(), s.tolist()
    sa = [-1] * n
    for p in reversed(leftmost.tolist()):
        tails[symbol[p]] -= 1
        sa[tails[symbol[p]]] = p
    for i in range(n):
        p = sa[i] - 1
        if p >= 0 and not small[p]:
            sa[heads[symbol[p]]] = p
            heads[symbol[p]] += 1
    tails = end.tolist()
    # all smaller suffixes are placed anew, the last one, alone in its bucket, by itself
    sa[0] = n - 1
    for i in range(n - 1, -1, -1):
        p = sa[i] - 1
        if p >= 0 and small[p]:
            tails[symbol[p]] -= 1
            sa[tails[symbol[p]]] = p
    return np.array(sa, np.int64)


def suffix_array(t: np.ndarray, k: int, induced=induce) -> np.ndarray:
    """Suffix array of symbols below k; the last symbol must be 0 and nowhere else.

    Leftmost-smaller substrings are sorted by induction and named; where names repeat, the string of names, a third as
    long or so, is sorted in the same way.
    """
    s = smaller_types(t)
    is_left = np.zeros(len(t), bool)
    is_left[1:] = s[1:] & ~s[:-1]
    left = np.flatnonzero(is_left)
    if len(left) > 1:
        sa = induced(t, s, left, k)
        ranked = sa[is_left[sa]]
        to = np.full(len(t), -1, np.int64)
        to[left[:-1]] = left[1:]
        a, b = ranked[:-1], ranked[1:]
        size = to - np.arange(len(t)) + 1
        differs = (size[a] != size[b]) | (to[a] < 0)
        open_ = np.flatnonzero(~differs)
        j = 0
        while len(open_):
            x, y = a[open_] + j, b[open_] + j
            unlike = t[x] != t[y]
            differs[open_[unlike]] = True
            open_ = open_[~unlike & (size[a[open_]] > j + 1)]
            j += 1
        name = np.concatenate([[0], np.cumsum(differs)])
        if name[-1] == len(left) - 1:
            left = ranked
        else:
            names = np.empty(len(t), np.int64)
            names[ranked] = name
            left = left[suffix_array(names[left], int(name[-1]) + 1, induce_by_scan)]
    return induced(t, s, left, k)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position of t, in text order: the suffix before it in sa (-1: none), and how many symbols they share.

    A position where the symbols before both suffixes are equal shares one symbol less than the position before it. So
    only the others are compared, four symbols of 16 bits at a time; what they share adds up to O(n log n).
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    chained = np.zeros(n, bool)
    chained[1:] = (before[1:] > 0) & (t[:-1] == t[before[1:] - 1])
    chained[1:] &= before[1:] > 0
    padded = np.concatenate([t.astype("<u2"), np.zeros(8, "<u2")])
    word = np.empty(n + 4, np.uint64)
    for shift in range(4):
        w = padded[shift : shift + (len(padded) - shift) // 4 * 4].view("<u8")
        word[shift::4] = w[: len(word[shift::4])]
    shared = np.zeros(n, np.int64)
    open_ = np.flatnonzero(~chained & (before >= 0))
    p, q, k = open_, before[open_], 0
    while len(p):
        x = word[p + k] ^ word[q + k]
        rest = np.minimum(4, n - k - np.maximum(p, q))  # symbols left of the shorter suffix
        low = x & (~x + np.uint64(1))
        same = np.where(x == 0, 4, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) // 16)
        same = np.minimum(same, rest)
        shared[p] += same
        on = same == 4
        p, q, k = p[on], q[on], k + 4
        inside = k + np.maximum(p, q) < n
        p, q = p[inside], q[inside]
    from_ = np.maximum.accumulate(np.where(chained, -1, np.arange(n)))
    shared = np.where(chained, shared[from_] - (np.arange(n) - from_), shared)
    return before, shared


def repeated_prefixes(t: np.ndarray, sa: np.ndarray, able: np.ndarray, length: int) -> np.ndarray:
    """Whether the length symbols at each position also start elsewhere.

    able: positions that length symbols of one text follow. Suffixes that share them stand together in sa.
    """
    before, shared = permuted_common_prefixes(t, sa)
    p = np.flatnonzero(able & (shared >= length))
    p = p[able[before[p]]]
    out = np.zeros(len(t), bool)
    out[p] = out[before[p]] = True
    return out
