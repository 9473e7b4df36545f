"""NumPy building blocks over Arrow string columns: blocks of bytes, hashes, words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_WS = np.zeros(256, bool)
_WS[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (a bijection on 64-bit integers)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    col = col.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf, off


def blocks(off: np.ndarray, target: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``target`` bytes; a longer text is a block of its own."""
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + target, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def octets(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one integer (length n - 7)."""
    if len(buf) < 8:
        return np.zeros(0, U)
    b = np.ascontiguousarray(buf)
    return np.ndarray((len(b) - 7,), "<u8", b, 0, (1,)).copy()


_POW = {"p": np.ones(1, U), "i": np.ones(1, U), "t": mix(np.arange(1, 257).astype(U))}
_BASE, _INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["p"]) < n:
        m = max(n, 1 << 20)
        with np.errstate(over="ignore"):
            for k, base in (("p", _BASE), ("i", _INV)):
                step = np.full(m, base, U)
                step[0] = 1
                _POW[k] = np.multiply.accumulate(step)
    return _POW["p"][:n], _POW["i"][:n]


def word_hashes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of a block, in order. ``off`` starts at 0."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    inside = ~_WS[buf]
    first = np.zeros(n + 1, bool)
    first[off] = True  # a text begins here, so no word crosses
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.concatenate((inside[1:], [False]))
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    p, inv = _powers(n)
    sums = np.concatenate((np.zeros(1, U), np.cumsum(_POW["t"][buf] * p)))
    h = mix((sums[ends] - sums[starts]) * inv[starts] + (ends - starts).astype(U))
    row = np.searchsorted(off, starts, "right") - 1
    return h, row


def shingles(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``k`` words; a shorter text is one shingle."""
    n = len(h)
    if n == 0:
        return h, row
    counts = np.bincount(row)
    acc = np.zeros(n, U)
    idx = np.arange(n)
    last = np.cumsum(counts)[row]  # end of the row's words
    for j in range(k):
        at = np.minimum(idx + j, n - 1)
        here = idx + j < last
        acc = mix(acc * U(0x9E3779B97F4A7C15) + np.where(here, h[at], U(j + 1)))
    start = last - counts[row]
    keep = (idx + k <= last) | ((counts[row] < k) & (idx == start))
    return acc[keep], row[keep]


def occurrences(e: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(element, row, count) of a multiset per row, sorted by row and element."""
    if len(e) == 0:
        return e, row, np.zeros(0, np.int64)
    order = np.lexsort((e, row))
    e, row = e[order], row[order]
    new = np.concatenate(([True], (e[1:] != e[:-1]) | (row[1:] != row[:-1])))
    at = np.flatnonzero(new)
    return e[at], row[at], np.diff(np.concatenate((at, [len(e)])))
