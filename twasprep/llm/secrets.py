"""Secret scan with a recursive decoding worklist.

Each text is scanned for three kinds (assignments, access keys, long hex runs).
Then it is unwrapped: percent escapes, Unicode escapes (backslash and numeric
HTML forms), base64 runs (also over several lines, or with words joined to them),
and compressed data inside base64, percent or \\x escapes are decoded
in place, each kind at once over the whole layer. Every new layer goes on a
worklist, is scanned with the same rules, and is unwrapped again until nothing
decodes; layers already seen (by hash) are not repeated, so cyclic or self-
reproducing input ends. Every character of a layer knows the code points of the
original text it stems from, so a match found in any layer is reported as a
span of the original. Spans of the plain text always stay; decoded layers add.

Compressed data (gzip, zlib, bzip2, xz, raw deflate, several members, one inside
another) is decompressed as a stream. What opens to little is put in its place;
the rest is scanned in windows that overlap and are never cut inside an encoded
run, each a layer of its own, with its first and last characters in its place:
every character of packed data stems from the whole run, so no positions are
kept, and memory is bounded by the window (and the longest encoded run in it),
not by what the data opens to.

Edge cases: null and empty texts have no findings; runs that decode to bytes
without ASCII text are left as they are, other stray bytes become U+FFFD; packed
data that breaks off counts as far as whole members go; equal spans of one kind
are reported once (the first layer's); repeated rows are scanned alike; an empty
table gives no rows; texts of any length are scanned whole; only the id and text
columns are read. ``refused`` counts xz runs whose dictionary exceeds
``DICTIONARY``; they stay scanned in their encoded form.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the three kinds, in the order that sorts them.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
WORDS = ("passw", "secret", "token", "api")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}"
                    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
#: A run and the lines that go on with it; _base64 decides which of them belong together.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)*+={0,2}")
PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
#: Beginnings of gzip, zlib, bzip2 and xz data, as bytes and under escapes, with what may follow.
XZ = b"\xfd7zXZ\x00"
MAGIC = re.compile(rb"\x1f\x8b\x08|[\x08-\x78][\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
PACKED_URL = re.compile(r"(?:%1[fF]%8[bB]|(?:x|%78)%[0-9A-Fa-f]{2}|(?:x|%78)(?:\^|%5[eE])|(?:B|%42)(?:Z|%5[aA])(?:h|%68)|%[fF][dD](?:7|%37)(?:z|%7[aA]))"
                        r"(?:%[0-9A-Fa-f]{2}|[^%\s])*+")
PACKED_X = re.compile(r"(?:\\x1[fF]\\x8[bB]|(?:x|\\x78)(?:\\x[0-9A-Fa-f]{2}|\^)|BZh[1-9]|\\x[fF][dD]7zXZ)"
                      r"(?:\\x[0-9A-Fa-f]{2}|\\[tnr0abfv'\"\\]|[^\\\r\n])*+")
BACKSLASH = {"t": 9, "n": 10, "r": 13, "0": 0, "a": 7, "b": 8, "f": 12, "v": 11}
#: Bytes of packed output that are put in place whole; of more, the two ends.
INLINE = 1 << 17
#: Bytes of a window of packed output, and how far windows overlap.
WINDOW, OVERLAP = 1 << 22, 1 << 16
STEP = 1 << 20
#: Memory that an xz dictionary may ask for.
DICTIONARY = 300 << 20
#: What an encoded run may hold, lines and all; a window is not cut inside one.
RUN_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=\r\n\t %\\"
#: Control characters that text does not hold (tab, line ends, form feed and vertical tab may stand).
BINARY = re.compile(r"[\x00-\x08\x0e-\x1a\x1c-\x1f\x7f]")
#: ASCII text in data that is not text as a whole (the shortest match has 16 characters).
RUN = re.compile(rb"[\x20-\x7e]{12,}")
WIDE_LE, WIDE_BE = re.compile(rb"(?:[\x20-\x7e]\x00){12,}"), re.compile(rb"(?:\x00[\x20-\x7e]){12,}")


def scan(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all matches, leftmost and non-overlapping per kind."""
    out = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(w in low for w in WORDS):
            for m in ASSIGN.finditer(text):
                if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                    out.append((0, m.start(), m.end()))
    if "AKIA" in text:
        out += [(1, *m.span()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= ACCESS_LEAST]
    out += [(2, *m.span()) for m in HEX.finditer(text)]
    return out


def _strict(data: bytes) -> str | None:
    """The text of ``data`` if it is UTF-8 (or UTF-16 with a mark or of ASCII text) without binary controls."""
    try:
        if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
            t = data.decode("utf-16")
        elif len(data) % 2 == 0 and len(data) >= 8 and not any(data[1::2]):
            t = data.decode("utf-16-le")
        elif len(data) % 2 == 0 and len(data) >= 8 and not any(data[::2]):
            t = data.decode("utf-16-be")
        else:
            t = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return t if t and not BINARY.search(t) else None


def _sizes(t: str) -> np.ndarray:
    """UTF-8 bytes of each character (an escaped stray byte counts as one)."""
    cp = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = 1 + (cp > 0x7F).astype(np.int64) + (cp > 0x7FF) + (cp > 0xFFFF)
    return np.where((cp >= 0xDC80) & (cp <= 0xDCFF), 1, n)


def _bytewise(data: bytes) -> tuple[str, np.ndarray]:
    """Text of any bytes and the number of bytes of each character: UTF-8 where it fits, U+FFFD elsewhere."""
    t = data.decode("utf-8", "surrogateescape")
    return re.sub("[\udc80-\udcff]", "\ufffd", t), _sizes(t)


def _wide_sizes(t: str, lead: int) -> np.ndarray:
    size = np.where(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) < 0x10000, 2, 4)
    size[:1] += lead
    return size


def _decoded(data: bytes) -> tuple[str, np.ndarray] | None:
    """(text, bytes of each character) of any data that holds ASCII text, else None.

    Strict text always counts; other bytes only if they hold a run of ``RUN`` printable ASCII characters.
    """
    t = _strict(data)
    if t is not None:
        if t.encode("utf-8") == data:
            return t, _sizes(t)
        return t, _wide_sizes(t, 2 if data[:2] in (b"\xff\xfe", b"\xfe\xff") else 0)
    if not RUN.search(data):
        # UTF-16 with stray units: keep the ASCII text of either alignment
        wide = [m for m in (WIDE_LE.search(data), WIDE_BE.search(data)) if m]
        if not wide:
            return None
        code = "utf-16-le" if wide[0].re is WIDE_LE else "utf-16-be"
        off = wide[0].start() % 2
        t = data[off:].decode(code, "replace")
        return t, _wide_sizes(t, off)
    return _bytewise(data)


class _Broken(ValueError):
    """Not compressed, or broken before its first member ends."""


def _decompressor(head: bytes):
    if head[:2] == b"\x1f\x8b" or (len(head) > 5 and head[0] & 15 == 8 and (head[0] * 256 + head[1]) % 31 == 0):
        return zlib.decompressobj(47)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == XZ:
        return lzma.LZMADecompressor(memlimit=DICTIONARY)
    return None


def _unpack(chunks: Iterator[bytes], raw: bool = False) -> Iterator[bytes]:
    """One decompression step over all members, in pieces of at most ``STEP`` bytes."""
    d, data, done = None, b"", False
    ended = False
    chunks = iter(chunks)
    while True:
        if not data or (d is None and len(data) < 6 and not ended):
            more = next(chunks, None)
            if more is None:
                ended = True
            else:
                data += more
                continue
        if not data:
            break
        if d is None:
            d = zlib.decompressobj(-15) if raw and not done else _decompressor(data)
            if d is None:
                break
        try:
            got = d.decompress(data, STEP)
            if got:
                yield got
            data = d.unconsumed_tail if hasattr(d, "unconsumed_tail") else b""
            while not d.eof and (len(got) == STEP if hasattr(d, "unconsumed_tail") else not d.needs_input):
                got = d.decompress(data, STEP)
                if got:
                    yield got
                data = d.unconsumed_tail if hasattr(d, "unconsumed_tail") else b""
                if not got:
                    break
        except (zlib.error, lzma.LZMAError, OSError, EOFError, ValueError) as e:
            if done:
                return
            raise _Broken(str(e)) from e
        if d.eof:
            data, d, done = d.unused_data, None, True
            if raw and data:
                raise _Broken("bytes after the data")
    if not done:
        raise _Broken("not whole")


class _Packed:
    """Packed data that decompresses as a whole: its size, its ends, and a source to read it again."""

    def __init__(self, source: Callable[[], Iterator[bytes]]):
        self.source, self.size = source, 0
        head, tail, mark = b"", b"", hashlib.blake2b(digest_size=16)
        for piece in source():
            self.size += len(piece)
            mark.update(piece)
            if len(head) < INLINE:
                head += piece[:INLINE - len(head)]
            tail = (tail + piece)[-(INLINE // 2):]
        self.head, self.tail, self.mark = head, tail, mark.digest()

    def text(self) -> str:
        """The text, or its two ends."""
        if self.size <= INLINE:
            return _text_of(self.head)
        return _text_of(self.head[:INLINE // 2]) + "\n" + _text_of(self.tail)

    def windows(self) -> Iterator[str]:
        """All of the text in overlapping windows (none if :meth:`text` holds it all)."""
        if self.size <= INLINE:
            return
        code = _wide_code(self.head)
        held = b""
        for piece in self.source():
            held += piece
            # a run that fills the overlap may go on: the window waits for its end
            if len(held) >= WINDOW and held[-OVERLAP:].strip(RUN_BYTES):
                yield held.decode(code, "replace")
                held = held[-OVERLAP:]
        yield held.decode(code, "replace")


def _wide_code(head: bytes) -> str:
    if head[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16-le" if head[0] == 0xFF else "utf-16-be"
    if not any(head[1:512:2]):
        return "utf-16-le"
    return "utf-16-be" if not any(head[:512:2]) else "utf-8"


def _text_of(data: bytes) -> str:
    t = _strict(data)
    if t is None:
        wide = _decoded(data)
        t = wide[0] if wide else _bytewise(data)[0]
    return t


def _expanded(data: bytes, refused: list, raw: bool = False) -> _Packed | None:
    """What lies below all compression steps, or None if ``data`` is not compressed.

    ``raw``: headerless deflate counts too, where all of it is one and opens to text."""
    if _decompressor(data) is None and not raw:
        return None
    source, found, seen = (lambda: iter([data])), None, set()
    while True:
        head = next(iter(source()), b"") if found else data
        bare = raw and found is None and _decompressor(head) is None
        if not bare and _decompressor(head) is None:
            return found
        try:
            step = _Packed(lambda above=source, bare=bare: _unpack(above(), bare))
        except _Broken as e:
            if "emory" in str(e):
                refused.append(len(data))
            return found
        if not step.size or step.mark in seen:
            return found
        if bare and (step.size < 8 or _strict(step.head[:INLINE // 2]) is None and not RUN.search(step.head)):
            return None
        seen.add(step.mark)
        found, source = step, step.source


def _percent(m: re.Match, refused: list):
    raw = bytes.fromhex(m.group().replace("%", ""))
    try:
        t = raw.decode("utf-8")
        size = _sizes(t)
    except UnicodeDecodeError:
        t, size = raw.decode("latin-1"), np.ones(len(raw), np.int64)
    end = np.cumsum(size)
    return t, 3 * (end - size), 3 * end


def _escape(m: re.Match, refused: list):
    g = m.group()
    if g[0] == "&":
        code = int(g[3:-1], 16) if g[2] in "xX" else int(g[2:-1])
    else:
        code = int(g[2:].strip("{}"), 16)
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return chr(code), 0, len(g)


def _bytes(body: str) -> bytes:
    body = body[:len(body) - (len(body) % 4 == 1)].replace("-", "+").replace("_", "/")
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _run(body: str, refused: list, loose: bool = True) -> list[tuple]:
    """Texts (or packed data) of a base64 run, with the characters of ``body`` that
    each of their characters stems from: (text, starts, ends).

    A run that is text or compressed as it stands is that; otherwise (``loose``)
    it is decoded at each of the four offsets, for words may be joined to its
    beginning, and every piece of text or compressed data in it counts.
    """
    n = len(body)
    whole = _bytes(body) if n % 4 != 1 else b""
    strict = _strict(whole)
    t = _expanded(whole, refused, raw=strict is None and n % 4 != 1)
    if t is not None:
        return [(t, 0, n)]
    if not loose and strict is None:
        return []
    out = []
    for off in range(4 if strict is None else 1):
        data = _bytes(body[off:]) if off or n % 4 == 1 else whole
        text = _decoded(data) if off == 0 or RUN.search(data) or _strict(data) else None
        if text is not None:
            end = np.cumsum(text[1])
            out.append((text[0], off + 8 * (end - text[1]) // 6, np.minimum(off - (-8 * end // 6), n)))
        if strict is None:
            for m in MAGIC.finditer(data):
                if m.start() and (t := _expanded(data[m.start():], refused)):
                    out.append((t, min(off + 8 * m.start() // 6, n - 1), n))
                elif off and not m.start() and (t := _expanded(data, refused)):
                    out.append((t, off, n))
    return out


def _base64(m: re.Match, refused: list):
    """Lines of one width (the first and last may be shorter) are one run if that decodes."""
    g = m.group()
    pieces = [(p.start(), p.group()) for p in PIECE.finditer(g)]
    out, done, got = [], 0, False

    def plain(a: int, b: int) -> None:
        if a < b:
            out.append((g[a:b], np.arange(a, b), np.arange(a + 1, b + 1)))

    i = 0
    while i < len(pieces):
        j = i + 1
        width = len(pieces[j][1]) if j < len(pieces) else 0
        while j < len(pieces) and len(pieces[j][1]) == width:
            j += 1
        if i + 1 < j < len(pieces) and len(pieces[j][1]) < width:
            j += 1
        parts: list = []
        for k, loose in ((j, False), (j - 1, False), (j, True)):
            if k <= i:
                continue
            where = np.concatenate([np.arange(a, a + len(p)) for a, p in pieces[i:k]])
            parts = [(t, where[x], where[y - 1] + 1)
                     for t, x, y in _run("".join(p for _, p in pieces[i:k]), refused, loose)]
            if parts:
                break
        if j > i + 1 and (not parts or loose):
            # lines that are no run together may be runs of their own
            k = j
            for a, p in pieces[i:j]:
                if len(p) >= 16:
                    parts += [(t, a + x, a + y) for t, x, y in _run(p, refused)]
        if not parts:
            k = j
        first, last = pieces[i][0], pieces[k - 1][0] + len(pieces[k - 1][1])
        plain(done, first)
        for x, part in enumerate(parts):
            if x:
                out.append(("\n", first, first + 1))
            out.append(part)
        got = got or bool(parts)
        if not parts:
            plain(first, last)
        done, i = last, k
    plain(done if done < len(g) and g[done] != "=" else len(g), len(g))
    return out if got else None


def _packed_url(m: re.Match, refused: list):
    t = _expanded(unquote_to_bytes(m.group()), refused)
    return None if t is None else (t, 0, len(m.group()))


def _packed_x(m: re.Match, refused: list):
    data = re.sub(r"\\(?:x([0-9A-Fa-f]{2})|(.))", lambda e: chr(
        int(e[1], 16) if e[1] else BACKSLASH.get(e[2], ord(e[2]))), m.group())
    t = _expanded(data.encode("latin-1", "replace"), refused)
    return None if t is None else (t, 0, len(m.group()))


#: name, pattern, decoder, a character that any match must hold
CODECS = (("url", PERCENT, _percent, "%"), ("unicode", ESCAPE, _escape, "\\&"),
          ("base64", BASE64, _base64, ""), ("url", PACKED_URL, _packed_url, "%"),
          ("unicode", PACKED_X, _packed_x, "\\"))


class Layer:
    """A text whose characters stem from ``start``:``end`` of the original: arrays,
    or two numbers where all stem from the same characters (None: itself)."""

    def __init__(self, text: str, start=None, end=None, path: str = ""):
        self.text, self.start, self.end, self.path = text, start, end, path

    def origin(self, start, end):
        """Original code points of the layer's ``start``:``end`` (numbers or arrays)."""
        if self.start is None:
            return start, end
        if np.ndim(self.start) == 0:
            return self.start, self.end
        return self.start[start], self.end[np.asarray(end) - 1]

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The smallest original span of the layer's ``start``:``end``."""
        if self.start is None or np.ndim(self.start) == 0:
            return self.origin(start, end)
        return int(self.start[start:end].min()), int(self.end[start:end].max())


def unwrap(layer: Layer, codec, refused: list, windows: Callable[[Layer], None]) -> Layer | None:
    """The layer below under one codec, or None. Windows of packed data that does not
    fit in it are handed to ``windows`` as they come."""
    name, pattern, decode, need = codec
    text, path = layer.text, f"{layer.path}/{name}"
    if need and not any(c in text for c in need):
        return None
    parts, lo, hi, at, flat = [], [], [], 0, np.ndim(layer.start) == 0 and layer.start is not None

    def put(t: str, start, end) -> None:
        parts.append(t)
        if not flat:
            lo.append(np.broadcast_to(start, len(t)))
            hi.append(np.broadcast_to(end, len(t)))

    def keep(a: int, b: int) -> None:
        put(text[a:b], *layer.origin(np.arange(a, b), np.arange(a + 1, b + 1)))

    for m in pattern.finditer(text):
        found = decode(m, refused)
        if found is None:
            continue
        keep(at, m.start())
        for t, a, b in found if isinstance(found, list) else [found]:
            start, end = layer.origin(m.start() + a, m.start() + b)
            if isinstance(t, _Packed):
                for window in t.windows():
                    windows(Layer(window, int(start), int(end), path))
                t = t.text()
            put(t, start, end)
        at = m.end()
    if not parts:
        return None
    keep(at, len(text))
    if flat:
        return Layer("".join(parts), layer.start, layer.end, path)
    return Layer("".join(parts), np.concatenate(lo), np.concatenate(hi), path)


def _mark(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def findings(text: str) -> tuple[list[dict], int]:
    """All findings of a text (dicts, sorted by start, kind, end) and refused runs."""
    known = {(k, s, e): "" for k, s, e in scan(text)}
    refused: list = []
    seen = {_mark(text)}

    def descend(layer: Layer) -> None:
        """Scan a decoded layer and everything below it, unless it was seen."""
        mark = _mark(layer.text)
        if mark in seen:
            return
        seen.add(mark)
        for k, s, e in scan(layer.text):
            known.setdefault((k, *layer.span(s, e)), layer.path)
        work(layer)

    def work(first: Layer) -> None:
        todo = [first]
        while todo:
            layer = todo.pop()
            for codec in CODECS:
                below = unwrap(layer, codec, refused, descend)
                if below is None or (mark := _mark(below.text)) in seen:
                    continue
                seen.add(mark)
                for k, s, e in scan(below.text):
                    known.setdefault((k, *below.span(s, e)), below.path)
                todo.append(below)

    work(Layer(text))
    rows = [{"kind": KINDS[k], "start": int(s), "end": int(e), "layer": p}
            for (k, s, e), p in sorted(known.items(), key=lambda x: (x[0][1], x[0][0], x[0][2]))]
    return rows, len(refused)


FINDINGS = "array<struct<kind:string,start:int,end:int,layer:string>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                             ("layer", pa.string())]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, findings (layer '' is the text itself), refused."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            found, refused = [], []
            for t in b.column("text"):
                f, r = findings(t.as_py() or "")
                found.append(f)
                refused.append(r)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(found, _ARROW), pa.array(refused, pa.int32())],
                ["doc_id", "findings", "refused"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, findings {FINDINGS}, refused int")


def span_list(spans: Column) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
