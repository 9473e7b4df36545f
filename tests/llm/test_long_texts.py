"""Very long texts: bounded memory and time linear in the text, nothing lost."""

import base64
import bz2
import gzip
import lzma
import subprocess
import sys
import time
import zlib
from pathlib import Path

import numpy as np
import pytest

from twasprep.llm import decontam, secrets, toxicity

ROOT = str(Path(__file__).resolve().parents[2])
SECRET = 'password = "hunter2hunter2"'


def b64(data):
    return base64.b64encode(data).decode()


def raw_deflate(data):
    c = zlib.compressobj(9, zlib.DEFLATED, -15)
    return c.compress(data) + c.flush()


def found(text):
    rows, refused = secrets.findings(text)
    assert refused == 0
    return {(f["kind"], f["start"], f["end"]) for f in rows if f["layer"]}


PACK = {"gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress,
        "deflate": raw_deflate, "gzip members": lambda d: gzip.compress(d[:9]) + gzip.compress(d[9:]),
        "xz in gzip": lambda d: gzip.compress(lzma.compress(d)),
        "deep": lambda d: zlib.compress(bz2.compress(gzip.compress(d)))}


@pytest.mark.parametrize("how", sorted(PACK))
@pytest.mark.parametrize("size", [0, 5000, 9_000_000])
def test_every_packing_is_opened_at_any_size(how, size):
    filler = b"some words of a log line, and more of them\n"
    data = filler * (size // len(filler)) + SECRET.encode() + b"\n" + filler * (size // len(filler))
    run = b64(PACK[how](data))
    text = f"see {run} here"
    assert ("assign", 4, 4 + len(run.rstrip("="))) in {(k, s, min(e, 4 + len(run.rstrip("=")))) for k, s, e in found(text)}


def test_windows_are_cut_beside_runs_not_inside():
    inner = b64(gzip.compress(np.random.default_rng(1).bytes(6_000_000) + SECRET.encode()))
    text = "x " + b64(gzip.compress((inner + " " + "y " * 3_000_000 + b64(SECRET.encode())).encode()))
    kinds = [f for f in secrets.findings(text)[0] if f["kind"] == "assign"]
    assert len(kinds) == 1 and kinds[0]["start"] == 2


def test_a_match_over_the_edge_of_packed_data():
    value = b64(gzip.compress(b"abcdefghijklmnop" + b" and text" * 40_000))
    text = f"token = {value}"
    assert any(f["kind"] == "assign" and f["layer"] and f["start"] == 0 for f in secrets.findings(text)[0])


def test_a_secret_behind_200_mb_in_bounded_memory():
    code = f"""
import base64, resource, sys, zlib
sys.path.insert(0, {ROOT!r})
from twasprep.llm import secrets
c = zlib.compressobj(1)
parts = [c.compress(b"some words of a log line, and more of them 12345\\n" * 20_000) for _ in range(200)]
parts += [c.compress({SECRET.encode()!r} + b"\\n"), c.flush()]
text = "see " + base64.b64encode(b"".join(parts)).decode()
rows, refused = secrets.findings(text)
assert refused == 0 and [f["kind"] for f in rows if f["layer"]] == ["assign"], rows
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-800:]
    assert int(out.stdout) < 500


def _seconds(f, *a):
    t = time.process_time()
    f(*a)
    return time.process_time() - t


def test_hits_of_one_long_line_are_judged_in_linear_time():
    scan = toxicity.Scanner([("trash", False, 5.0, True)])
    line = 'you are trash and "this trash" is quoted ' * 5_000
    count = toxicity._count([line * 10, "", line], scan)
    assert count.tolist() == [[50_000, 0, 50_000], [0, 0, 0], [5_000, 0, 5_000]]
    # 200 kB and 2 MB: ten times the text, not a hundred times the seconds
    assert _seconds(toxicity._count, [line * 10], scan) < 30 * max(_seconds(toxicity._count, [line], scan), 0.05)


def test_swapped_letters_are_one_edit():
    scan = toxicity.Scanner([("idiot", False, 5.0, True), ("pathetic", False, 5.0, True)], 4, True)
    words = ["idoit", "pahtetic", "pathetci", "diiot", "idito", "dioit", "padiot"]
    row, start, end, near = scan.hits([" ".join(words)])
    text = " ".join(words)
    assert {text[s:e] for s, e in zip(start, end)} == {"idoit", "pahtetic", "pathetci", "diiot", "idito"}
    assert near.all()


ITEMS = [(1, b"-" * 300), (2, b"-=" * 150), (3, b"-" * 40 + b"a real question with words enough" + b"-" * 60)]


def test_repeated_grams_take_bounded_memory_and_linear_time():
    code = f"""
import resource, sys
sys.path.insert(0, {ROOT!r})
import numpy as np
from twasprep.llm import decontam
index = decontam.ItemIndex({ITEMS!r})
for c in (b"-", b"-="):
    text = (c * 2_000_000)[:2_000_000]
    got = [x[:5] for x in index.matches(np.frombuffer(text, np.uint8), np.array([0, len(text)]))]
    assert got == [(0, 0 if c == b"-" else 1, 0, 300, 0)], got
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-800:]
    assert int(out.stdout) < 600


@pytest.mark.parametrize("seed", range(4))
def test_repetitive_items_match_brute_force(seed):
    import random

    rng = random.Random(seed)
    pool = [b"-" * 90, b"ab" * 50, b"word word word " * 8, b"-" * 30 + b"text in the middle of it" + b"-" * 30]
    index = decontam.ItemIndex(list(enumerate(pool)))
    for _ in range(25):
        text = bytearray(b"".join(rng.choice([x, x[:40], b"- ", b"filler of words "]) for x in rng.choices(pool, k=3)))
        for _ in range(rng.randrange(9)):
            p = rng.randrange(len(text))
            text[p:p + rng.randrange(2)] = rng.choice([b"", b"z", b"-"])
        text = bytes(text)
        got = {}
        for r in index.matches(np.frombuffer(text, np.uint8), np.array([0, len(text)])):
            got[r[1]] = min(got.get(r[1], 99), r[4])
        want = {}
        for i, item in enumerate(pool):
            row = np.zeros(len(text) + 1, int)
            for j, c in enumerate(item, 1):
                new = np.concatenate(([j], np.minimum(row[1:] + 1, row[:-1] + (np.frombuffer(text, np.uint8) != c))))
                row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
            if row.min() <= decontam.edit_budget(len(item)):
                want[i] = int(row.min())
        assert got == want
