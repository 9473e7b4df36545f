"""Suffix arrays of byte strings by induced sorting, vectorised with NumPy.

``suffix_array`` classifies suffixes as S or L, sorts the leftmost-S (LMS)
substrings by induction, ranks the shortened string of their names, and induces
the whole array from the sorted LMS suffixes; each induction handles one bucket
(one first character) at a time with array operations, so the work is linear in
the text. Order is guaranteed for the first ``depth`` characters (suffixes that
agree so far are adjacent), which is all that matching runs of that length need.
"""

from __future__ import annotations

import numpy as np


def _index(n: int):
    """The type of positions in ``n`` characters."""
    return np.int32 if n < 1 << 31 else np.int64


def classify(s: np.ndarray) -> np.ndarray:
    """True where the suffix is of type S (smaller than the next one). The end counts as L."""
    n = len(s)
    up = np.zeros(n, bool)
    if n < 2:
        return up
    rise = s[1:] > s[:-1]
    change = np.where(s[1:] != s[:-1], np.arange(n - 1, dtype=_index(n)), _index(n)(n - 1))
    nxt = np.minimum.accumulate(change[::-1])[::-1]  # next position whose successor differs
    known = nxt < n - 1
    up[:-1][known] = rise[nxt[known]]
    return up


def _induce(s, up, lms, sigma, heads):
    """Suffix array induced from LMS suffixes given in order."""
    n = len(s)
    sizes = np.diff(heads)
    n_l = np.bincount(s[~up], minlength=sigma)
    sa = np.full(n, -1, _index(n))
    # first character of each suffix's predecessor, ``sigma`` if it is of the other type
    code = np.uint8 if sigma < 256 else np.uint16 if sigma < 1 << 16 else np.int64
    before = np.full((2, n), sigma, code)
    for k, kind in enumerate((~up[:-1], up[:-1])):
        before[k, 1:][kind] = s[:-1][kind]
    # L suffixes, buckets upwards: a bucket's L part is filled by smaller
    # buckets and by itself (runs of one character), then its LMS part follows
    fill = heads[:-1].copy()
    # the suffix after the end is the empty one: it induces the last suffix first
    if n and not up[n - 1]:
        sa[fill[s[n - 1]]] = n - 1
        fill[s[n - 1]] += 1
    by = s[lms]
    order = np.argsort(by, kind="stable")
    lms_sorted, lms_bounds = lms[order], np.searchsorted(by[order], np.arange(sigma + 1))

    def taken(src, k):
        """Predecessors of the type by first character (in their order), and how many each has."""
        c = before[k][src]
        some = c != sigma
        c = c[some]
        o = np.argsort(c, kind="stable")
        return (src[some] - 1)[o], c[o], np.bincount(c, minlength=sigma)

    def push(src):
        """Place the L-type predecessors of ``src`` (already in order)."""
        p, c, count = taken(src, 0)
        if len(p):
            sa[(fill - np.cumsum(count) + count)[c] + np.arange(len(c))] = p
            fill[:] += count

    for c in np.flatnonzero(sizes):
        done = heads[c]
        while done < fill[c]:
            upto = fill[c]
            push(sa[done:upto])
            done = upto
        push(lms_sorted[lms_bounds[c]:lms_bounds[c + 1]])
    # S suffixes, buckets downwards
    tail = heads[1:].copy()

    def push_s(src):
        """Place the S-type predecessors of ``src``, which comes in descending order."""
        p, c, count = taken(src, 1)
        if len(p):
            sa[(tail - 1 + np.cumsum(count) - count)[c] - np.arange(len(c))] = p
            tail[:] -= count

    for c in np.flatnonzero(sizes)[::-1]:
        done = heads[c + 1]
        while done > tail[c]:
            upto = tail[c]
            push_s(sa[upto:done][::-1])
            done = upto
        push_s(sa[heads[c]:heads[c] + n_l[c]][::-1])
    return sa


def _lms_names(s, lms, order):
    """Rank of each LMS substring (equal ones share it), aligned with ``lms``."""
    n, m = len(s), len(lms)
    end = np.append(lms[1:], n - 1)  # last character of each, the next LMS included
    size = np.zeros(n, _index(n))
    size[lms] = end - lms + 1
    a, b = order[:-1], order[1:]
    equal = size[a] == size[b]
    alive = np.flatnonzero(equal)
    a, b, left = a[alive], b[alive], size[a[alive]]
    step = 0
    while len(alive):
        same = s[a + step] == s[b + step]
        equal[alive[~same]] = False
        step += 1
        same &= left > step
        alive, a, b, left = alive[same], a[same], b[same], left[same]
    rank = np.empty(n, _index(n))
    rank[order] = np.concatenate(([0], np.cumsum(~equal)))
    return rank[lms].astype(np.int64)


def _rank_reduced(names, rounds):
    """Order of the suffixes of the reduced string, doubling the sorted length each round."""
    m = len(names)
    rank = names
    length = 1
    for _ in range(rounds):
        if rank.max(initial=0) == m - 1:
            break
        key = rank * (m + 2)
        key[:-length] += rank[length:] + 1 if length < m else 0
        order = np.argsort(key)
        key = key[order]
        rank = np.empty(m, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        length *= 2
        if length >= m:
            break
    return np.argsort(rank, kind="stable")


def suffix_array(s: np.ndarray, depth: int = 1 << 30) -> np.ndarray:
    """Start positions of the suffixes of ``s`` in order (of their first ``depth`` characters)."""
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64)
    sigma = int(s.max()) + 1
    heads = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=sigma))))
    up = classify(s)
    lms = (np.flatnonzero(up[1:] & ~up[:-1]) + 1).astype(_index(n))
    if len(lms) > 1:
        first = _induce(s, up, lms, sigma, heads)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        names = _lms_names(s, lms, first[is_lms[first]])
        # an LMS substring moves at least two characters on
        rounds = max(1, int(np.ceil(np.log2(min(depth, n) / 2 + 2))))
        lms = lms[_rank_reduced(names, rounds)]
    return _induce(s, up, lms, sigma, heads)


def permuted_common_prefix(s: np.ndarray, sa: np.ndarray, least: int) -> np.ndarray:
    """In text order: whether a suffix shares ``least`` characters with the one before it
    in the suffix array (the permuted LCP array cut at ``least``)."""
    n = len(s)
    before = np.full(n, -1, _index(n))
    before[sa[1:]] = sa[:-1]
    out = np.zeros(n, bool)
    at = np.flatnonzero(before >= 0).astype(_index(n))
    at = at[(at + least <= n) & (before[at] + least <= n)]
    step = 8
    if n >= step and least >= step and s.max(initial=0) < 256:
        wide = np.ndarray((n - 7,), "<u8", np.ascontiguousarray(s.astype(np.uint8)), 0, (1,))
        for lo in range(0, len(at), 1 << 20):
            x = at[lo:lo + (1 << 20)]
            for o in [*range(0, least - step + 1, step), least - step]:
                x = x[wide[x + o] == wide[before[x] + o]]
            out[x] = True
        return out
    for o in range(least):
        at = at[s[at + o] == s[before[at] + o]]
    out[at] = True
    return out
