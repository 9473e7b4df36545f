"""Exact substring dedup: remove bytes covered by a 50-byte string that also
starts in a document with a smaller id, decided by sharded suffix arrays.

Three passes, each sharded by content so that equal strings always meet:

1. Every 50-byte window picks its least hashed 24-byte gram as anchor
   (winnowing); windows in a row with one anchor form one string of 50 to 76
   bytes. All equal windows have equal anchors, so anchors shard the windows.
   Only 16 bytes of hashes per string travel. Equal strings within a batch are
   settled there (all but the least document are copies), equal strings across
   batches in the shard of their anchor: a copy's bytes go, the least document's
   string stays as the one representative. Where that document holds the string
   several times, the other places are noted as repeats of the first.
2. Where an anchor has several different strings, their windows may still be
   equal in part. Equal windows hold as many bytes before the anchor, so they fall
   in one of four classes and share its bytes around the anchor; strings that share
   a class's hash byte with no other document's have no equal window and stay. The
   others' bytes are cut from the texts, gathered in shards (by anchor; class by
   class, by the bytes it shares, when an anchor has more than ``HOT`` strings), and
   a suffix array per shard, built by induced sorting, with permuted common prefixes
   brings equal 50-byte windows together; each is removed unless its document is the
   least of the run.
3. Windows removed from a string are removed from its repeats too; the removed
   ranges are merged per document and cut out.

What a shard finds goes to parts by a hash of the document, one packed row for
each shard and part, and is put together by document there: the rows between the
passes do not grow with documents times shards.

Strings are compared in pass 1 by 96 bits of hashes (plus the shard): 48 of their
anchor, 48 chained over all of their bytes; in pass 2 byte by byte.

Edge cases: null counts as empty; texts under 50 bytes lose nothing; strings
repeated inside one document are kept; rows with equal ids never remove each
other; a null id sorts before every other id (two null rows keep their bytes
against each other; -2^63 counts as null); repeated rows are judged alike; an empty table gives no
rows; only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twasprep.llm import suffixes, textvec as tv
from twasprep.llm.common import materialise, partitions

U = tv.U
LENGTH = 50
GRAM = 24
WINDOW = LENGTH - GRAM + 1  # grams per window: 27
BLOCK = 1 << 16  # bytes hashed at a time: the arrays stay in the processor's cache
FLUSH = 1 << 20  # strings held before a batch of them is sent
CUT = 1 << 22  # bytes cut at a time
HOT = 4096
SORT_SHARDS = 4  # suffix-array shards per shuffle partition
#: Windows by the bytes before their anchor: those of one class share its bytes around the anchor.
CLASSES = ((0, 6), (7, 13), (14, 20), (21, 26))
#: The octets, from the anchor, that hold these bytes (without the anchor's own).
OCTETS = ((24, 32, 36), (-7, 24, 29), (-14, -8, 22), (-21, -13, -8))
_NULL_ID = -(1 << 63)
_STRINGS = {"anchor": 6, "text": 6, "at": 4, "n": 1, "piece": 4}
_CUTS = {"at": 4, "n": 4}
_REPEATS = {"origin": 4, "at": 4, "n": 1}
_PROBES = {"anchor": 6, "at": 4, "n": 1, "hot": 1}
_PROBE = np.dtype([("anchor", "<u8"), ("at", "<i4"), ("n", "<i2"), ("hot", "<i2")])
_ITEM = np.dtype([("doc_id", "<i8"), ("tkey", "<i8"), ("at", "<i4"), ("size", "<i4")])


# -- packing: byte planes of integer columns, so that shuffle compression finds the zeros

def _order(where: np.ndarray) -> np.ndarray:
    """Stable order of small non-negative integers."""
    small = len(where) and where.max() < 1 << 16
    return np.argsort(where.astype(np.uint16) if small else where, kind="stable")


def _packs(where, doc, ids, keys, cols, spec, parts, rows=None):
    """(where, blob) for each value of ``where``: ids and keys of the documents, then the columns
    (of ``rows`` of them)."""
    if not len(where):
        return
    order = _order(where)
    where, doc = where[order], doc[order]
    order = order if rows is None else rows[order]
    cut = np.concatenate(([True], where[1:] != where[:-1]))
    new = cut.copy()
    new[1:] |= doc[1:] != doc[:-1]
    wide = np.empty((len(where), 1 + sum(spec.values())), np.uint8)
    wide[:, 0] = new
    at = 1
    for name, width in spec.items():
        wide[:, at:at + width] = cols[name][order].astype(U).view(np.uint8).reshape(-1, 8)[:, :width]
        at += width
    at = np.flatnonzero(new)
    ids, keys = ids[doc[at]], keys[doc[at]]
    lo = np.flatnonzero(cut)
    hi = np.append(lo[1:], len(where))
    nth = np.cumsum(new)
    step = ids.copy()  # ids as steps from the one before
    step[1:] -= ids[:-1]
    step[nth[lo] - 1] = ids[nth[lo] - 1]
    step = step.view(np.uint8).reshape(-1, 8)
    for w, x, y, a, b in zip(where[lo].tolist(), lo.tolist(), hi.tolist(), (nth[lo] - 1).tolist(),
                             nth[hi - 1].tolist()):
        yield w, b"".join((np.array([b - a, y - x, parts], np.int64).tobytes(), step[a:b].T.tobytes(),
                           keys[a:b].tobytes(), wide[x:y].T.tobytes()))


def _opened(blobs: list[bytes], spec):
    """(ids, keys, document of each row, byte planes, parts) of all blobs."""
    ids, keys, planes, parts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], 0
    width = 1 + sum(spec.values())
    for blob in blobs:
        nd, n, parts = np.frombuffer(blob, np.int64, 3).tolist()
        step = np.frombuffer(blob, np.uint8, 8 * nd, 24).reshape(8, nd).T
        ids.append(np.cumsum(np.ascontiguousarray(step).view(np.int64).ravel()))
        keys.append(np.frombuffer(blob, np.int64, nd, 24 + 8 * nd))
        planes.append(np.frombuffer(blob, np.uint8, width * n, 24 + 16 * nd).reshape(width, n))
    planes = np.concatenate(planes, axis=1) if planes else np.zeros((width, 0), np.uint8)
    return (np.concatenate(ids), np.concatenate(keys), np.cumsum(planes[0], dtype=np.int64) - 1,
            planes, parts)


def _column(planes: np.ndarray, spec, name: str, rows=slice(None)) -> np.ndarray:
    """A column (hashes unsigned) of byte planes."""
    at = 1 + sum(list(spec.values())[:list(spec).index(name)])
    first = planes[at][rows]
    wide = np.zeros((len(first), 8), np.uint8)
    for k in range(spec[name]):
        wide[:, k] = planes[at + k][rows]
    return wide.view(U if spec[name] > 4 else np.int64).ravel()


def _unpack(blobs: list[bytes], spec):
    """(ids, keys, document of each row, columns) of all blobs."""
    ids, keys, doc, planes, _ = _opened(blobs, spec)
    return ids, keys, doc, {k: _column(planes, spec, k) for k in spec}


def _part(ids: np.ndarray, keys: np.ndarray, parts: int) -> np.ndarray:
    """The part that gathers what is found about a document."""
    return (tv.mix(ids.view(U) ^ tv.mix(keys.view(U))) % U(parts)).astype(np.int64)


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column of ``counts`` consecutive values each."""
    off = pa.array(np.concatenate(([0], np.cumsum(counts))) * values.dtype.itemsize, pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(counts), [
        None, off.buffers()[1], pa.py_buffer(values.view(np.uint8))])


def _values(col, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(values, how many each) of a binary column; nulls are empty."""
    col = col.cast(pa.large_binary()).fill_null(b"")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
    if off[-1] == off[0]:
        return np.zeros(0, dtype), np.zeros(len(col), np.int64)
    size = np.dtype(dtype).itemsize
    return np.frombuffer(col.buffers()[2], dtype, (off[-1] - off[0]) // size, off[0]), np.diff(off) // size


def _steps(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. of each count, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _gram_hashes(x: np.ndarray) -> np.ndarray:
    """Hash of the gram at each position, from the octets; it only picks and groups anchors."""
    if x.shape[-1] < 17:
        return np.zeros((*x.shape[:-1], 0), U)
    h = x[..., :-16] * U(0x9E3779B97F4A7C15)
    h += x[..., 8:-8] * U(0xC2B2AE3D27D4EB4F)
    h ^= h >> U(29)
    h += x[..., 16:] * U(0x165667B19E3779F9)
    return tv.mix(h)


def _pieces(x, anchor, before, size):
    """A hash byte per class: of the bytes its windows share, 0 if the string has no such window.

    Equal windows of two strings have one anchor, are of one class and share its bytes, so
    strings of an anchor that agree in no class have no window in common.
    """
    pad = np.zeros(32, U)
    x, at = np.concatenate((pad, x, pad)), anchor + 32
    out = np.zeros(len(anchor), U)
    for k, ((lo, hi), (o, p, q)) in enumerate(zip(CLASSES, OCTETS)):
        h = x[at + o] * U(0x9E3779B97F4A7C15)
        h += x[at + p] * U(0xC2B2AE3D27D4EB4F)
        h ^= h >> U(29)
        h += x[at + q] * U(0x165667B19E3779F9)
        h ^= h >> U(32)
        h *= U(0xBF58476D1CE4E5B9)
        has = (before >= lo) & (before - size + 1 <= hi)
        out |= np.where(has, np.maximum(h >> U(56), U(1)), U(0)) << U(8 * k)
    return out


def strings(buf: np.ndarray, off: np.ndarray):
    """(anchor hash, string hash, row, start, windows, pieces) of all anchored strings of a block."""
    none = np.zeros(0, np.int64)
    x = tv.octets(buf)
    g = _gram_hashes(x)
    n = len(buf) - LENGTH + 1
    if n <= 0:
        return none.astype(U), none.astype(U), none, none, none, none.astype(U)
    # least gram of each window; equal hashes are told apart by position, leftmost first
    key = g & U(0xFFFFFFFF00000000)
    key |= np.arange(len(g), dtype=U)
    m, have = key, 1
    while have * 2 <= WINDOW:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    m = np.minimum(m[:n], m[WINDOW - have: WINDOW - have + n])
    # windows must not cross texts: each text's last 49 starts are out
    ok = np.ones(n + 1, bool)
    first = np.maximum(off[1:] - LENGTH + 1, off[:-1])
    over = off[1:] - first
    ok[np.minimum(np.repeat(first, over) + _steps(over), n)] = False
    ok[n] = False
    new = np.ones(n + 1, bool)
    np.not_equal(m[1:], m[:-1], out=new[1:n])
    new[1:n] |= ~ok[:n - 1]
    starts = np.flatnonzero(new[:n] & ok[:n])
    stops = np.flatnonzero((new[1:] | ~ok[1:]) & ok[:n]) + 1
    size = stops - starts
    least = (m[starts] & U(0xFFFFFFFF)).astype(np.int64)
    last = starts + size + LENGTH - 1 - 8  # the last octet of the string
    text = tv.mix(size.astype(U))
    for o in range(0, LENGTH + WINDOW - 1, 8):
        text = tv.mix(text ^ x[np.minimum(starts + o, last)])
    row = np.searchsorted(off, starts, "right") - 1
    return (tv.mix(g[least] ^ U(0x632BE59BD9B4E019)), text, row.astype(np.int32),
            (starts - off[row]).astype(np.int32), size.astype(np.uint8),
            _pieces(x, least, least - starts, size).astype(np.uint32))


def _runs(doc: np.ndarray, at: np.ndarray, n: np.ndarray):
    """Windows [at, at + n) of documents, in order, as maximal runs."""
    if not len(doc):
        return doc, at, n
    lo = (doc << 33) + at
    reach = np.maximum.accumulate(lo + n)
    new = np.concatenate(([True], lo[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], at[first], reach[last] - lo[first]


def _table(rows, names):
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(
        zip(*rows) if rows else [[]] * len(names), [x[1] for x in names])], [x[0] for x in names])


# kinds: 0 strings, 1 windows to remove, 2 strings to look into, 3 repeats of these
_SENT = "shard int, kind int, part int, payload binary"
_FOUND = "kind int, part int, payload binary"
_FOUND_COLS = [("kind", pa.int32()), ("part", pa.int32()), ("payload", pa.binary())]
_SENT_COLS = [("shard", pa.int32()), *_FOUND_COLS]


def _send(batches, shards: int):
    """Strings to the shards of their anchors, after settling copies inside the batch."""

    def flush(ids, keys, held):
        ids, keys = np.concatenate(ids), np.concatenate(keys)
        anchor, text, doc, at, n, piece = (np.concatenate(x) for x in zip(*held))
        held.clear()
        # of equal strings the least document id stays (any rows with that id stay)
        order = np.argsort(text)
        a, t, d = anchor[order], text[order], ids[doc[order]]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (t[1:] != t[:-1])))
        least = np.minimum.reduceat(d, np.flatnonzero(new))
        gone = np.zeros(len(order), bool)
        gone[order[d > least[np.cumsum(new) - 1]]] = True
        del order, a, t, d, new, least
        cut = np.flatnonzero(gone)
        x, y, z = _runs(*(v[cut].astype(np.int64) for v in (doc, at, n)))
        part = _part(ids, keys, shards)
        rows = [(w, 1, w, blob) for w, blob in _packs(
            part[x], x, ids, keys, {"at": y, "n": z}, _CUTS, shards)]
        stay = np.flatnonzero(~gone)
        where = ((anchor[stay] >> U(48)) * U(shards) >> U(16)).astype(np.int64)
        rows += [(w, 0, None, blob) for w, blob in _packs(where, doc[stay], ids, keys, {
            "anchor": anchor, "text": text, "at": at, "n": n, "piece": piece}, _STRINGS, shards, stay)]
        return _table(rows, _SENT_COLS).to_batches()

    ids, keys, held, size, count = [], [], [], 0, 0
    for b in batches:
        buf, off = tv.utf8(b.column("text"))
        d, k = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tkey"))
        for lo, hi in tv.blocks(off, BLOCK):
            anchor, text, row, at, n, piece = strings(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            if len(n):
                held.append((anchor, text, row + np.int32(count), at, n, piece))
                size += len(n)
            ids.append(d[lo:hi])
            keys.append(k[lo:hi])
            count += hi - lo
            if size >= FLUSH:
                yield from flush(ids, keys, held)
                ids, keys, held, size, count = [], [], [], 0, 0
    if held:
        yield from flush(ids, keys, held)


def _payloads(table: pa.Table, kind: int) -> list[bytes]:
    return table.filter(pa.array(table.column("kind").to_numpy() == kind)).column("payload").to_pylist()


def _shared(group: np.ndarray, doc: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Strings that may have a window in common with one of another document of their group."""
    out = np.zeros(len(group), bool)
    for k in range(len(CLASSES)):
        h = (piece >> (8 * k)) & 255
        at = np.flatnonzero(h)
        if not len(at):
            continue
        key = (group[at] << 8) | h[at]
        order = np.argsort(key)
        key, at = key[order], at[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        start, run = np.flatnonzero(new), np.cumsum(new) - 1
        mixed = np.minimum.reduceat(doc[at], start) != np.maximum.reduceat(doc[at], start)
        out[at[mixed[run]]] = True
    return out


def _meet(table: pa.Table) -> pa.Table:
    """One shard: copies across batches (kind 1), strings to look into (kind 2), repeats (kind 3)."""
    done = table.filter(pa.array(table.column("kind").to_numpy() == 1)).select(["kind", "part", "payload"])
    ids, keys, doc, planes, parts = _opened(_payloads(table, 0), _STRINGS)
    if not len(doc):
        return done
    # an anchor met once settles nothing
    a = _column(planes, _STRINGS, "anchor")
    order = np.argsort(a)
    a = a[order]
    same = a[1:] == a[:-1]
    order = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
    if not len(order):
        return done
    a, t, at, n, piece = (_column(planes, _STRINGS, k, order) for k in _STRINGS)
    doc = doc[order]
    del planes, same
    order = np.lexsort((t, a))
    a, t, at, n, piece, doc = (v[order] for v in (a, t, at, n, piece, doc))
    d = ids[doc]
    new_a = np.concatenate(([True], a[1:] != a[:-1]))
    new = new_a | np.concatenate(([True], t[1:] != t[:-1]))
    string, group = np.cumsum(new) - 1, np.cumsum(new_a) - 1
    copy = d > np.minimum.reduceat(d, np.flatnonzero(new))[string]
    # different strings of an anchor, of different documents, that may have equal windows
    n_text = np.bincount(group, weights=new)
    stay = np.flatnonzero(~copy & (n_text > 1)[group])
    stay = stay[_shared(group[stay], d[stay], piece[stay])]
    # a string's first place in each text of its least document is looked into
    x, y = at[stay], keys[doc[stay]]
    by = np.lexsort((x, y, string[stay]))
    stay, x, y = stay[by], x[by], y[by]
    lead = np.ones(len(stay), bool)
    lead[1:] = (string[stay[1:]] != string[stay[:-1]]) | (y[1:] != y[:-1])
    look, origin = stay[lead], x[lead][np.cumsum(lead) - 1]
    again = x != origin  # (equal rows have it at the same place)
    other = stay[again]
    hot = np.bincount(group[look], minlength=group[-1] + 1)[group[look]] > HOT
    cut = np.flatnonzero(copy)
    cut = cut[np.argsort((doc[cut] << 32) | at[cut])]
    part = _part(ids, keys, parts)
    i, lo, m = _runs(doc[cut], at[cut], n[cut])
    rows = [(1, w, blob) for w, blob in _packs(part[i], i, ids, keys, {"at": lo, "n": m}, _CUTS, parts)]
    by = np.argsort(doc[look], kind="stable")
    look, hot = look[by], hot[by]
    rows += [(2, w, blob) for w, blob in _packs(part[doc[look]], doc[look], ids, keys, {
        "anchor": a[look], "at": at[look], "n": n[look], "hot": hot}, _PROBES, parts)]
    rows += [(3, w, blob) for w, blob in _packs(part[doc[other]], doc[other], ids, keys, {
        "origin": origin[again], "at": at[other], "n": n[other]}, _REPEATS, parts)]
    return pa.concat_tables([done, _table(rows, _FOUND_COLS).cast(done.schema)])


def _numbered(ids: np.ndarray, keys: np.ndarray):
    """(ids, keys) without repeats and the number of each given one among them."""
    order = np.lexsort((keys, ids))
    d, k = ids[order], keys[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    nth = np.empty(len(d), np.int64)
    nth[order] = np.cumsum(new) - 1
    return d[new], k[new], nth


_PER_DOC = "doc_id bigint, tkey bigint, "


def _gather(table: pa.Table) -> pa.Table:
    """One part: runs of windows to remove and repeats, by document."""
    ids, keys, doc, c = _unpack(_payloads(table, 1), _CUTS)
    ids3, keys3, doc3, r = _unpack(_payloads(table, 3), _REPEATS)
    n1 = len(ids)
    ids, keys, nth = _numbered(np.concatenate((ids, ids3)), np.concatenate((keys, keys3)))
    doc, doc3 = nth[doc], nth[n1 + doc3]
    order = np.argsort((doc << 32) | c["at"])
    doc, at, n = _runs(doc[order], c["at"][order], c["n"][order])
    order = np.argsort(doc3, kind="stable")
    return pa.Table.from_arrays([
        pa.array(ids), pa.array(keys),
        _binary(np.stack([at, n], axis=1).astype("<i4").ravel(), 2 * np.bincount(doc, minlength=len(ids))),
        _binary(np.stack([r[k][order] for k in _REPEATS], axis=1).astype("<i4").ravel(),
                3 * np.bincount(doc3, minlength=len(ids)))], ["doc_id", "tkey", "cuts", "repeats"])


def _probes(table: pa.Table) -> pa.Table:
    """One part: the strings to look into, by document."""
    ids, keys, doc, c = _unpack(_payloads(table, 2), _PROBES)
    ids, keys, nth = _numbered(ids, keys)
    doc = nth[doc]
    order = np.argsort(doc, kind="stable")
    p = np.empty(len(doc), _PROBE)
    for k in _PROBES:
        p[k] = c[k][order]
    return pa.Table.from_arrays([pa.array(ids), pa.array(keys), _binary(
        p, np.bincount(doc, minlength=len(ids)))], ["doc_id", "tkey", "probes"])


def _classed(buf, at, n, anchor, shards: int):
    """(source, start, windows, shard) of the strings by class, sharded by what each class shares."""
    out = [[np.zeros(0, np.int64)] for _ in range(4)]
    wide = LENGTH + WINDOW - 1
    for a in range(0, len(at), 1 << 14):
        x, m = at[a:a + (1 << 14)], n[a:a + (1 << 14)]
        size = m + LENGTH - 1
        body = buf[x[:, None] + np.minimum(np.arange(wide), size[:, None] - 1)]
        octets = np.ndarray((len(x), wide - 7), "<u8", body, 0, (wide, 1))
        g = _gram_hashes(octets) >> U(32)
        g[np.arange(g.shape[1]) > size[:, None] - GRAM] = U(0xFFFFFFFFFF)
        before = np.argmin(g, axis=1)  # the anchor: the least gram, leftmost
        for (lo, hi), offsets in zip(CLASSES, OCTETS):
            first, last = np.maximum(before - hi, 0), np.minimum(before - lo, m - 1)
            has = np.flatnonzero(first <= last)
            h = anchor[has + a] + U(lo)
            for o in offsets:
                h = tv.mix(h ^ octets[has, before[has] + o])
            for k, v in enumerate((has + a, (x + first)[has], (last - first + 1)[has],
                                   (h % U(shards)).astype(np.int64))):
                out[k].append(v)
    return [np.concatenate(v) for v in out]


def _cut(batches, shards: int):
    """The bytes of the strings to look into, gathered per shard."""
    names = [("shard", pa.int32()), ("payload", pa.binary())]
    for b in batches:
        buf, off = tv.utf8(b.column("text"))
        ids, keys = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tkey"))
        p, counts = _values(b.column("probes"), _PROBE)
        row = np.repeat(np.arange(len(ids)), counts)
        at, n = off[row] + p["at"], p["n"].astype(np.int64)
        where = ((p["anchor"] >> U(20)) % U(shards)).astype(np.int64)
        hot = p["hot"] > 0
        if hot.any():  # one string per class of windows
            src, x, m, w = _classed(buf, at[hot], n[hot], p["anchor"][hot], shards)
            row, at, n, where = (np.concatenate((u[~hot], v)) for u, v in (
                (row, row[hot][src]), (at, x), (n, m), (where, w)))
        size = n + LENGTH - 1
        upto = np.cumsum(size)
        stops = np.searchsorted(upto, np.arange(CUT, upto[-1] + CUT, CUT), "right") if len(upto) else []
        for a, z in zip([0, *stops], stops):
            order = a + _order(where[a:z])
            if not len(order):
                continue
            r, x, m, w = row[order], at[order], size[order], where[order]
            text = buf[np.repeat(x, m) + _steps(m)]
            head = np.empty(len(order), _ITEM)
            head["doc_id"], head["tkey"], head["at"], head["size"] = ids[r], keys[r], x - off[r], m
            lo = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
            hi = np.append(lo[1:], len(w))
            byte = np.concatenate(([0], np.cumsum(m)))
            rows = [(s, b"".join((np.array([v - u], "<i8").tobytes(), head[u:v].tobytes(),
                                  text[byte[u]:byte[v]].tobytes())))
                    for s, u, v in zip(w[lo].tolist(), lo.tolist(), hi.tolist())]
            yield from _table(rows, names).to_batches()


def _sort(table: pa.Table, parts: int) -> pa.Table:
    """One shard: suffix array of its strings; equal windows of larger ids are removed."""
    heads, texts = [], []
    for blob in table.column("payload").to_pylist():
        n = int(np.frombuffer(blob, "<i8", 1)[0])
        heads.append(np.frombuffer(blob, _ITEM, n, 8))
        texts.append(np.frombuffer(blob, np.uint8, offset=8 + _ITEM.itemsize * n))
    head, text = np.concatenate(heads), np.concatenate(texts)
    del heads, texts
    size = head["size"].astype(np.int64)
    # strings end with a separator below every byte (0xFF never occurs in UTF-8)
    total = int(size.sum()) + len(size)
    s = np.zeros(total, np.uint8)
    stops = np.cumsum(size + 1)
    body = np.ones(total, bool)
    body[stops - 1] = False
    s[body] = text + np.uint8(1)
    sa = suffixes.suffix_array(s, LENGTH + 1)
    # keep suffixes that begin a whole window of their string
    windows = np.zeros(total + 1, np.int8)
    windows[stops - size - 1] += 1
    windows[stops - LENGTH] -= 1
    whole = np.cumsum(windows[:-1], dtype=np.int8) > 0
    sa = sa[whole[sa]]
    rows = []
    if len(sa):
        same = suffixes.permuted_common_prefix(s, sa, LENGTH)[sa]
        # only windows that have an equal one can go
        some = same.copy()
        some[:-1] |= same[1:]
        sa, same = sa[some], same[some]
    if len(sa):
        owner = np.repeat(np.arange(len(size), dtype=np.int32), size + 1)[sa]
        ids = head["doc_id"][owner]
        copy = ids > np.minimum.reduceat(ids, np.flatnonzero(~same))[np.cumsum(~same) - 1]
        who, sa = owner[copy].astype(np.int64), sa[copy].astype(np.int64)
        at = head["at"][who] + sa - (stops - size - 1)[who]
        ids, keys, nth = _numbered(head["doc_id"][who], head["tkey"][who])
        order = np.argsort((nth << 32) | at)
        i, lo, m = _runs(nth[order], at[order], np.ones(len(at), np.int64))
        rows = [(1, w, blob) for w, blob in _packs(
            _part(ids, keys, parts)[i], i, ids, keys, {"at": lo, "n": m}, _CUTS, parts)]
    return _table(rows, _FOUND_COLS)


def _repeated(at: np.ndarray, n: np.ndarray, p: np.ndarray, size: int) -> np.ndarray:
    """Starts of the repeats of windows that begin in [at, at + n); ``size`` bytes of text."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    gone = np.cumsum(edge) > 0
    p = p.reshape(-1, 3).astype(np.int64)
    nth = _steps(p[:, 2])
    return (np.repeat(p[:, 1], p[:, 2]) + nth)[gone[np.repeat(p[:, 0], p[:, 2]) + nth]]


def _kept(batches):
    """Cut the merged ranges out of each text."""
    for b in batches:
        buf, off = tv.utf8(b.column("text"))
        cuts, count = _values(b.column("cuts"), "<i4")
        repeats, again = _values(b.column("repeats"), "<i4")
        row = np.repeat(np.arange(len(off) - 1), count // 2)
        at, n = cuts[::2].astype(np.int64), cuts[1::2].astype(np.int64)
        if len(repeats):
            ends, stops = np.cumsum(count // 2), np.cumsum(again)
            more = [(row, at, n)]
            for r in np.flatnonzero((again > 0) & (count > 0)):
                mine = slice(ends[r] - count[r] // 2, ends[r])
                x = _repeated(at[mine], n[mine], repeats[stops[r] - again[r]:stops[r]], off[r + 1] - off[r])
                more.append((np.full(len(x), r), x, np.ones(len(x), np.int64)))
            row, at, n = (np.concatenate(x) for x in zip(*more))
            order = np.argsort((row << 32) | at)
            row, at, n = row[order], at[order], n[order]
        row, at, n = _runs(row, at, n + LENGTH - 1)  # bytes now
        size = np.diff(off)
        per_row = np.bincount(row, minlength=len(size))
        removed = np.zeros(len(size), np.int64)
        np.add.at(removed, row, n)
        body = buf[off[0]:off[-1]]
        edge = np.zeros(len(body) + 1, np.int8)
        start = off[row] - off[0] + at
        edge[start] += 1
        edge[start + n] -= 1
        kept = body[np.cumsum(edge[:-1], dtype=np.int8) == 0] if len(row) else body
        spans = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(per_row))), pa.int32()),
            pa.StructArray.from_arrays([pa.array(at, pa.int64()), pa.array(at + n, pa.int64())], ["start", "end"]))
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), spans,
            _binary(np.ascontiguousarray(kept), size - removed)],
            ["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal removed byte runs), kept (binary)."""
    shards = partitions(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), text.alias("text"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NULL_ID)).alias("doc_id"),
        F.xxhash64(text).alias("tkey"))
    sent = rows.select("doc_id", "tkey", "text").mapInArrow(lambda it: _send(it, shards), _SENT)
    met = materialise(sent.groupBy("shard").applyInArrow(_meet, _FOUND), "met")
    probes = met.where("kind = 2").groupBy("part").applyInArrow(_probes, _PER_DOC + "probes binary")
    texts = rows.select("doc_id", "tkey", "text")
    one = probes.join(texts, ["doc_id", "tkey"]).select("doc_id", "tkey", "text", "probes")
    # suffix sorting takes about fifty bytes a byte: smaller shards for it
    fine = shards * SORT_SHARDS
    found = one.mapInArrow(lambda it: _cut(it, fine), "shard int, payload binary") \
        .groupBy("shard").applyInArrow(lambda t: _sort(t, shards), _FOUND)
    found = materialise(found, "found")
    cuts = met.where("kind <> 2").unionByName(found).groupBy("part").applyInArrow(
        _gather, _PER_DOC + "cuts binary, repeats binary")
    whole = rows.join(cuts, ["doc_id", "tkey"], "left").select(
        F.col("id").alias("doc_id"), "text", "cuts", "repeats")
    return whole.mapInArrow(_kept, (
        "doc_id bigint, n_bytes bigint, n_removed bigint, "
        "spans array<struct<start:bigint,end:bigint>>, kept binary"))
