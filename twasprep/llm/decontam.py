"""Benchmark decontamination by the q-gram lemma and banded alignment.

A benchmark item of m bytes is leaked if it occurs somewhere in a text within
k = 8 % of m edits (ASCII case ignored, UTF-8 bytes as characters). Then the
occurrence shares at least m - q + 1 - k * q of the item's q-grams, all on at
most 2k + 1 neighbouring diagonals (text position less item position). Shared
grams are counted per (text, item) in diagonal bands that overlap, so one band
holds them all; bands that reach the bound are kept and verified by alignment
inside the band. Nothing within the budget is lost, and nothing beyond it is
reported.

A gram that an item repeats (a row of dashes) is not paired occurrence by
occurrence: each of its text positions counts once in every band that any of
them falls into, which is at least what the lemma counts and at most about eight
bands an item. Positions are taken in stretches of ``PAIRS`` pairs, so memory
does not grow with the text or with its repeats.

The benchmark is a stated query set: it is read in blocks of ``BLOCK_BYTES`` of
item text, each shipped to the tasks and searched against all rows.

Edge cases: null or empty texts have no matches; null or empty items and items
shorter than ``Q`` bytes are not searched (too short to be evidence); short
items are searched by shorter grams (``QS``) so that the lemma still needs
``LEAST`` of them at the whole budget; equal items are reported each; repeated
rows are judged alike; of equally good alignments the first end, then the
shortest; texts of any length are searched whole; a column of the documents with
any name passes through :func:`drop_leaks`; empty tables give no rows (no
benchmark: all rows stay).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twasprep.llm import textvec as tv

U = tv.U
Q = 12  # bytes of the shortest item searched
QS = (12, 8, 5)  # gram sizes: the largest that fits an item's length
BUDGET = 0.08
LEAST = 4
BLOCK_BYTES = 4 << 20
TEXT_BLOCK = 1 << 21
#: Occurrences of a gram in one item from which it is counted by bands.
HEAVY = 8
#: (text position, item gram) pairs listed at a time.
PAIRS = 1 << 21
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def edit_budget(m: int) -> int:
    """Edits allowed for an item of ``m`` bytes."""
    return int(m * BUDGET)


def gram_size(m: int) -> int:
    """The largest gram of which an occurrence within the budget must share ``LEAST``."""
    k = edit_budget(m)
    return next((q for q in QS if m - (q - 1) - k * q >= LEAST), QS[-1])


def _grams(low: np.ndarray, q: int) -> np.ndarray:
    """Hash of the ``q`` bytes from each position (length n - q + 1)."""
    if len(low) < q:
        return np.zeros(0, U)
    if q == 12:
        x = tv.octets(low)
        return x[:-4] * U(0x9E3779B97F4A7C15) + (x[4:] >> U(32)) * U(0xC2B2AE3D27D4EB4F)
    x = np.zeros(len(low) - q + 1, U)
    for i in range(q):
        x = (x << U(8)) | low[i:len(low) - q + 1 + i].astype(U)
    return x * U(0x9E3779B97F4A7C15)  # odd: no two grams of up to 8 bytes agree


class ItemIndex:
    """A block of items, one gram index per gram size."""

    def __init__(self, items: list[tuple[object, bytes]]):
        self.ids = [i for i, _ in items]
        self.k = np.array([edit_budget(len(t)) for _, t in items], np.int64)
        size = [gram_size(len(t)) for _, t in items]
        self.parts = [(rows, GramIndex([items[i] for i in rows], q)) for q in QS
                      if (rows := [i for i, x in enumerate(size) if x == q])]

    def matches(self, buf: np.ndarray, off: np.ndarray) -> Iterator[tuple]:
        """(row, item index, start, end, distance, shared grams) over a block (off starts at 0)."""
        for rows, index in self.parts:
            for r, i, *rest in index.matches(buf, off):
                yield r, rows[i], *rest


class GramIndex:
    """Grams of items with one gram size: a filter table and their occurrences."""

    def __init__(self, items: list[tuple[object, bytes]], q: int):
        self.q = q
        self.low = [_LOWER[np.frombuffer(t, np.uint8)] for _, t in items]
        m = np.array([len(t) for t in self.low], np.int64)
        self.m, self.k = m, np.array([edit_budget(int(x)) for x in m], np.int64)
        self.need = m - (q - 1) - self.k * q
        self.width = 2 * self.k + 1
        g = [_grams(t, q) for t in self.low]
        allg = np.concatenate(g) if g else np.zeros(0, U)
        item = np.repeat(np.arange(len(g)), [len(x) for x in g])
        at = np.concatenate([np.arange(len(x)) for x in g]) if g else np.zeros(0, np.int64)
        allg, item, at, heavy = self._by_bands(allg, item, at)
        order = np.argsort(allg, kind="stable")
        self.item, self.at, self.heavy = item[order], at[order], heavy[order]
        self.grams, self.first, self.n = np.unique(allg[order], return_index=True, return_counts=True)
        bits = max(12, int(len(self.grams) * 16).bit_length())
        self.shift = U(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[self.grams >> self.shift] = True

    def _by_bands(self, gram, item, at):
        """Occurrences (gram, item, at, heavy); those of a gram that its item repeats
        give way to the band offsets they can fall into, each once.

        With P the band of a text position and b = at // width, the occurrence's
        band is P - b or P - b - 1."""
        order = np.lexsort((at, item, gram))
        gram, item, at = gram[order], item[order], at[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (item[1:] != item[:-1])
        group = np.cumsum(new) - 1
        many = (np.bincount(group) > HEAVY)[group] if len(group) else np.zeros(0, bool)
        block = at[many] // self.width[item[many]]
        rows = np.unique(np.concatenate([np.stack([group[many], block + d], 1) for d in (0, 1)]), axis=0)
        lead = np.flatnonzero(new)[rows[:, 0]]
        light = ~many
        return (np.concatenate([gram[light], gram[lead]]), np.concatenate([item[light], item[lead]]),
                np.concatenate([at[light], rows[:, 1]]),
                np.concatenate([np.zeros(int(light.sum()), bool), np.ones(len(rows), bool)]))

    def _counts(self, pos, slot, row, shiftup, span):
        """(key, count) of the bands that the positions' grams fall into, by stretches."""
        n = self.n[slot]
        ends = np.cumsum(n)
        keys, counts, a = [], [], 0
        while a < len(pos):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS, "right")))
            m = n[a:b]
            src = np.repeat(np.arange(a, b), m)
            occ = self.first[slot][src] + np.arange(len(src)) - np.repeat(np.cumsum(m) - m, m)
            item, at, width = self.item[occ], self.at[occ], self.width[self.item[occ]]
            place = pos[src] + shiftup
            band = np.where(self.heavy[occ], place // width - at, (place - at) // width)
            key, cnt = np.unique((row[src] * len(self.m) + item) * span + band, return_counts=True)
            keys.append(key)
            counts.append(cnt)
            a = b
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        return key, np.bincount(where, np.concatenate(counts)).astype(np.int64)

    def matches(self, buf: np.ndarray, off: np.ndarray) -> Iterator[tuple]:
        """(row, item index, start, end, distance, shared grams) over a block (off starts at 0)."""
        if not len(self.grams) or len(buf) < self.q:
            return
        low = _LOWER[buf]
        g = _grams(low, self.q)
        pos = np.flatnonzero(self.table[g >> self.shift])
        slot = np.searchsorted(self.grams, g[pos])
        slot[slot == len(self.grams)] = 0
        here = self.grams[slot] == g[pos]
        pos, slot = pos[here], slot[here]
        row = np.searchsorted(off, pos, "right") - 1
        inside = pos + self.q <= off[row + 1]
        pos, slot, row = pos[inside], slot[inside], row[inside]
        if not len(pos):
            return
        # bands of one width step; a run of 2k + 1 diagonals meets at most two in a row
        shiftup = int(self.m.max()) + int(self.width.max())
        span = (len(buf) + 2 * shiftup) + 2
        key, cnt = self._counts(pos, slot, row, shiftup, span)
        item_of = (key // span) % len(self.m)
        nxt = np.zeros(len(key), np.int64)
        if len(key) > 1:
            nxt[:-1] = np.where(key[1:] == key[:-1] + 1, cnt[1:], 0)
        good = cnt + nxt >= self.need[item_of]
        key, cnt, item_of = key[good], (cnt + nxt)[good], item_of[good]
        j = 0
        while j < len(key):
            e = j
            while e + 1 < len(key) and key[e + 1] <= key[e] + 2 and key[e + 1] // span == key[j] // span:
                e += 1
            i, r, w = int(item_of[j]), int(key[j] // span // len(self.m)), int(self.width[item_of[j]])
            d0 = int(key[j] % span) * w - shiftup
            d1 = (int(key[e] % span) + 2) * w - shiftup
            k, m = int(self.k[i]), int(self.m[i])
            lo, hi = max(int(off[r]), d0 - k), min(int(off[r + 1]), d1 + m + k)
            found = align(self.low[i], low[lo:hi], k, d0 - lo - k, d1 - lo + k)
            if found:
                s, t, dist = found
                base = int(off[r])
                yield r, i, lo + s - base, lo + t - base, dist, int(cnt[j:e + 1].max())
            j = e + 1


def align(item: np.ndarray, text: np.ndarray, k: int, d0: int, d1: int) -> tuple | None:
    """(start, end, distance) of the best occurrence of ``item`` in ``text`` whose path
    stays on the diagonals d0..d1, or None if it takes more than ``k`` edits.

    Ties: the first end, then the shortest occurrence.
    """
    at = text.tobytes().find(item.tobytes())
    if at >= 0:
        return at, at + len(item), 0
    end, dist = _band(item, text, d0, d1, free=True)
    if dist > k:
        return None
    back, _ = _band(item[::-1], text[:end][::-1], -k, k, free=False, want=dist)
    return end - back, end, dist


def _band(item, text, d0, d1, free, want=None):
    """Banded distances, one row of the matrix at a time; (text column, distance)."""
    m, n = len(item), len(text)
    idx = np.arange(d1 - d0 + 1)
    big = m + n + 2
    col = idx + d0  # text column j of diagonal j - i for item row i = 0
    row = np.where((col >= 0) & (col <= n), 0 if free else np.abs(col), big)
    for i in range(1, m + 1):
        col = idx + d0 + i
        ok = (col >= 1) & (col <= n)
        same = np.zeros(len(idx), bool)
        same[ok] = text[col[ok] - 1] == item[i - 1]
        best = np.where(ok, row + ~same, big)
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        best = np.where((col >= 0) & (col <= n), best, big)
        row = np.minimum.accumulate(best - idx) + idx
        row = np.where((col >= 0) & (col <= n), row, big)
    col = idx + d0 + m
    hit = np.flatnonzero(row == (row.min() if want is None else max(want, int(row.min()))))
    return int(col[hit[0]]), int(row[hit[0]])


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[object, bytes]]]:
    """The benchmark in blocks of bounded size (one block is on the driver at a time)."""
    block, size = [], 0
    rows = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")) \
        .where(F.octet_length("t") >= Q)
    for r in rows.toLocalIterator():
        t = r["t"].encode("utf-8")
        if block and size + len(t) > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["i"], t))
        size += len(t)
    if block:
        yield block


def _found(batch: pa.RecordBatch, text: str, index: ItemIndex) -> Iterator[tuple]:
    buf, off = tv.utf8(batch.column(text))
    for lo, hi in tv.blocks(off, TEXT_BLOCK):
        for r, *rest in index.matches(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]):
            yield lo + r, *rest


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, item_id, start, end (byte offsets), distance, budget, shared: one row per
    occurrence region, best alignment of each."""
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, item_id {item_kind}, start bigint, end bigint, distance int, "
              "budget int, shared bigint")
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    parts = []
    for block in item_blocks(benchmark):

        def search(batches, block=block):
            index = ItemIndex(block)
            for b in batches:
                rows = list(_found(b, "text", index))
                if rows:
                    r, i, s, e, d, n = zip(*rows)
                    yield pa.RecordBatch.from_arrays([
                        b.column("doc_id").take(pa.array(r)), pa.array([index.ids[x] for x in i]),
                        pa.array(s, pa.int64()), pa.array(e, pa.int64()), pa.array(d, pa.int32()),
                        pa.array([int(index.k[x]) for x in i], pa.int32()), pa.array(n, pa.int64())],
                        ["doc_id", "item_id", "start", "end", "distance", "budget", "shared"])

        parts.append(narrow.mapInArrow(search, schema))
    out = parts[0] if parts else narrow.sparkSession.createDataFrame([], schema)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any leaked item, unchanged (all columns)."""
    at = docs.columns.index(text_col)
    for block in item_blocks(benchmark):

        def clean(batches, block=block):
            index = ItemIndex(block)
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for r, *_ in _found(pa.RecordBatch.from_arrays([b.column(at)], ["t"]), "t", index):
                    keep[r] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
