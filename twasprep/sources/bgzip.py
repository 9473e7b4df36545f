"""Line scan of block-gzip files by several tasks per file.

A block-gzip file is a chain of gzip members of at most 64 kB, each naming its own
size in an extra field. A Python data source cuts a file into byte ranges; a
range's task finds the first block that begins in it (a header whose chain leads
to further headers), decompresses block by block and hands out lines in Arrow
batches. A line belongs to the range in which the line before it ends: every range but
the first skips to its first line end, and every range reads on to the first line
end at or after its own end. Plain gzip files are one range each.

Files are opened through ``pyarrow.fs`` (local paths, and the stores its URIs
know); the ordinary text scan reads what only Spark's file systems reach.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "block_gzip_lines"
SCHEMA = "file_path string, block long, row long, value string"
#: Compressed bytes of a range, and lines of an Arrow batch.
RANGE_BYTES = 8 << 20
BATCH = 4096
#: Largest block, header included.
BLOCK = 1 << 16
#: Headers that must follow one another for bytes to count as a block's begin.
CHAIN = 3


def block_size(data: bytes, at: int = 0) -> int | None:
    """Size of the block whose header begins at ``at``, None if none does there."""
    if len(data) < at + 18 or data[at:at + 4] != b"\x1f\x8b\x08\x04":
        return None
    extra, = struct.unpack_from("<H", data, at + 10)
    p, end = at + 12, at + 12 + extra
    while p + 4 <= min(end, len(data)):
        size, = struct.unpack_from("<H", data, p + 2)
        if data[p:p + 2] == b"BC" and size == 2 and p + 6 <= len(data):
            return struct.unpack_from("<H", data, p + 4)[0] + 1
        p += 4 + size
    return None


def first_block(f, start: int, end: int, size: int) -> int | None:
    """Offset of the first block that begins in start..end-1 of a file of ``size`` bytes."""
    f.seek(start)
    data = f.read(min(size - start, (end - start) + (CHAIN + 1) * BLOCK))
    at = data.find(b"\x1f\x8b\x08\x04")
    while 0 <= at < end - start:
        p, links = at, 0
        while links < CHAIN and (n := block_size(data, p)) is not None:
            p, links = p + n, links + 1
            if start + p >= size:
                return start + at
        if links == CHAIN:
            return start + at
        at = data.find(b"\x1f\x8b\x08\x04", at + 1)
    return None


def blocks(f, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, text bytes) of the blocks from offset ``at`` on."""
    while at < size:
        f.seek(at)
        head = f.read(min(BLOCK, size - at))
        n = block_size(head)
        if n is None:
            raise ValueError(f"no block at offset {at}")
        if len(head) < n:
            raise ValueError(f"the block at offset {at} is cut off")
        yield at, zlib.decompress(head[:n], 31)
        at += n


def range_lines(f, start: int, end: int, size: int) -> Iterator[bytes]:
    """The lines of one range, without their ends."""
    at = first_block(f, start, end, size)
    if at is None:
        return
    rest, skipping, past = b"", start > 0, False
    for offset, text in blocks(f, at, size):
        if not past and offset >= end:
            past = True
            if skipping:
                return  # no line begins in this range
        if past:
            cut = text.find(b"\n")
            if cut < 0:
                rest += text
                continue
            yield rest + text[:cut]
            return
        if skipping:
            cut = text.find(b"\n")
            if cut < 0:
                continue
            text, skipping = text[cut + 1:], False
        parts = (rest + text).split(b"\n")
        rest = parts.pop()
        yield from parts
    if rest:
        yield rest


def plain_lines(f) -> Iterator[bytes]:
    """All lines of a gzip file of any kind."""
    d, rest = zlib.decompressobj(31), b""
    while data := f.read(1 << 20):
        while data:
            parts = (rest + d.decompress(data)).split(b"\n")
            rest, data = parts.pop(), b""
            yield from parts
            if d.eof and d.unused_data:
                data, d = d.unused_data, zlib.decompressobj(31)
    if not d.eof:
        raise ValueError("the file is cut off")
    if rest:
        yield rest


def _open(path: str):
    """(file system, path in it) of a path as listings have it, not percent-encoded."""
    scheme, colon, rest = path.partition(":/")
    if not colon or scheme in ("", "file"):
        return pafs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    return pafs.FileSystem.from_uri(quote(path, safe="/:@"))


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, size: int, whole: bool):
        self.path, self.start, self.end, self.size, self.whole = path, start, end, size, whole


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], range_bytes: int):
        self.paths, self.range_bytes = paths, range_bytes

    def partitions(self) -> list[_Range]:
        out = []
        for path in self.paths:
            fs, inner = _open(path)
            size = fs.get_file_info(inner).size
            with fs.open_input_file(inner) as f:
                split = block_size(f.read(min(BLOCK, size))) is not None
            step = self.range_bytes if split else max(size, 1)
            out += [_Range(path, a, min(a + step, size), size, not split) for a in range(0, size, step)]
        return out

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        fs, inner = _open(part.path)
        with fs.open_input_file(inner) as f:
            lines = plain_lines(f) if part.whole else range_lines(f, part.start, part.end, part.size)
            held, row = [], 0
            for line in lines:
                held.append(line.removesuffix(b"\r"))
                if len(held) == BATCH:
                    yield self._batch(part, held, row)
                    held, row = [], row + BATCH
            if held:
                yield self._batch(part, held, row)

    @staticmethod
    def _batch(part: _Range, lines: list[bytes], row: int) -> pa.RecordBatch:
        n = len(lines)
        return pa.RecordBatch.from_arrays([
            pa.array([part.path] * n, pa.string()), pa.array([part.start] * n, pa.int64()),
            pa.array(range(row, row + n), pa.int64()),
            pa.array([x.decode("utf-8", "replace") for x in lines], pa.string())],
            ["file_path", "block", "row", "value"])


class BlockGzipLines(DataSource):
    """Options ``paths`` (one a line) and ``rangeBytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader([p for p in self.options["paths"].split("\n") if p],
                       int(self.options.get("rangeBytes", RANGE_BYTES)))


def read_gzip_lines(spark: SparkSession, paths: list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(file_path, line_no struct<block, row>, value)`` like ``read_lines(numbering="order")``,
    with one task per ``range_bytes`` of each block-gzip file."""
    spark.dataSource.register(BlockGzipLines)
    df = spark.read.format(NAME).option("paths", "\n".join(paths)).option("rangeBytes", str(range_bytes)).load()
    return df.select("file_path", F.struct("block", "row").alias("line_no"), "value")
