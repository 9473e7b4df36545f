"""Block-gzip files by ranges: every line once, in order, whatever the borders."""

import gzip
import io
import random
import struct
import zlib

import pytest

from conftest import write
from twasprep.plans import workflows as WF
from twasprep.sources import bgzip as Z
from twasprep.sources import tables as S
from twasprep.sources.text import read_lines
from twasprep.sources.vcf import read_vcf

EOF = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def block_gzip(data: bytes, sizes) -> bytes:
    out, at = [], 0
    while at < len(data):
        piece = data[at:at + next(sizes)]
        at += len(piece)
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(piece) + c.flush()
        head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + 25)
        out.append(head + body + struct.pack("<II", zlib.crc32(piece), len(piece)))
    return b"".join(out) + EOF


def sizes_of(rng, most):
    while True:
        yield rng.randrange(1, most)


@pytest.mark.parametrize("seed", range(8))
def test_ranges_share_out_the_lines(seed):
    rng = random.Random(seed)
    lines = [bytes(rng.choice(b"ACGT\t01|.") for _ in range(rng.choice([0, 3, 40, 900]))) for _ in range(400)]
    data = b"\n".join(lines) + rng.choice([b"", b"\n"])
    packed = block_gzip(data, sizes_of(rng, rng.choice([60, 700, 9000])))
    f = io.BytesIO(packed)
    for step in (30, 77, 500, 4096, 10 ** 9):
        got = [x for a in range(0, len(packed), step)
               for x in Z.range_lines(f, a, min(a + step, len(packed)), len(packed))]
        want = data.split(b"\n")
        assert got == (want[:-1] if want[-1] == b"" else want), step


def test_a_false_header_inside_a_block_is_no_begin():
    rng = random.Random(3)
    fake = block_gzip(b"x" * 20, iter([20, 20]))[:40]
    data = b"\n".join(rng.randbytes(300).replace(b"\n", b"") + fake.replace(b"\n", b"") for _ in range(200))
    packed = block_gzip(data, sizes_of(rng, 5000))   # random bytes are stored, false headers and all
    f = io.BytesIO(packed)
    got = [x for a in range(0, len(packed), 3000)
           for x in Z.range_lines(f, a, min(a + 3000, len(packed)), len(packed))]
    assert got == data.split(b"\n")


def test_one_file_is_read_by_several_tasks_and_equals_the_plain_scan(spark, tmpdir_path):
    rng = random.Random(5)
    rows = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2"]
    rows += [f"chr1\t{i}\trs{rng.random()}\tA\tG\t.\t.\t.\tGT\t0|1\t1|1" for i in range(5000)]
    text = ("\n".join(rows) + "\n").encode()
    (tmpdir_path / "v").mkdir()
    path = tmpdir_path / "v" / "chr1 x.vcf.gz"
    path.write_bytes(block_gzip(text, iter(lambda: 9000, None)))
    got = Z.read_gzip_lines(spark, [str(path)], range_bytes=4096)
    assert got.rdd.getNumPartitions() > 5
    values = [r.value for r in got.orderBy("line_no").collect()]
    assert values == rows == [r.value for r in read_lines(spark, str(path)).orderBy("line_no").collect()]
    a, b = read_vcf(spark, str(tmpdir_path / "v"), split_gzip=True), read_vcf(spark, str(tmpdir_path / "v"))
    pick = lambda v: sorted((r.pos, r.id, tuple(r.cells)) for r in v.records.collect())
    assert pick(a) == pick(b) and a.headers.first().sample_names == ["s1", "s2"]


def test_plain_gzip_and_cut_files(spark, tmpdir_path):
    p = tmpdir_path / "a.vcf.gz"
    p.write_bytes(gzip.compress(b"one\ntwo\n") + gzip.compress(b"three"))
    assert [r.value for r in Z.read_gzip_lines(spark, [str(p)]).collect()] == ["one", "two", "three"]
    packed = block_gzip(b"line\n" * 5000, iter(lambda: 900, None))
    p.write_bytes(packed[:len(packed) // 2])
    with pytest.raises(Exception):
        Z.read_gzip_lines(spark, [str(p)], range_bytes=1000).collect()


def test_landing_by_ranges(spark, tmpdir_path):
    text = "##x\n#CHROM\tPOS\tID\tREF\tALT\n" + "".join(f"1\t{i}\trs{i}\tA\tG\n" for i in range(1, 2000))
    (tmpdir_path / "d").mkdir()
    (tmpdir_path / "d" / "db.vcf.gz").write_bytes(block_gzip(text.encode(), iter(lambda: 700, None)))
    WF.land_dbsnp(spark, str(tmpdir_path / "d"), str(tmpdir_path / "pq"), split_gzip=True)
    rows = WF.read_landed_dbsnp(spark, str(tmpdir_path / "pq")).orderBy("ord").select("rsid").collect()
    assert [r.rsid for r in rows] == [f"rs{i}" for i in range(1, 2000)]
    plain = write(tmpdir_path / "p.vcf", text)
    assert S.read_dbsnp_vcf(spark, plain).count() == 1999
