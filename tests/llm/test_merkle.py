"""The manifest against plain hashing, over block borders, ties and nulls."""

import hashlib
import random
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from twasprep.llm import merkle

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Root, and per node its (left, right) siblings level by level."""
    sib, pos = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(pos):
            a = p // 16 * 16
            sib[i].append(("".join(nodes[a:p]), "".join(nodes[p + 1:a + 16])))
        nodes = [digest("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
        pos = [p // 16 for p in pos]
    return nodes[0], sib


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    key = lambda r: (r[1] is not None, (r[1] or "").encode())
    rows = sorted(rows, key=lambda r: (*key(r), r[0] is not None, r[0] or 0, leaf(r)))
    groups = [list(g) for _, g in groupby(rows, key)]
    trees = [tree([leaf(r) for r in g]) for g in groups]
    root, above = tree([t[0] for t in trees])
    out = []
    for g, (sub, sibs), up in zip(groups, trees, above):
        for r, own in zip(g, sibs):
            bad = list(r)
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                bad[4] = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            h = leaf(bad)
            for left, right in own + up:
                h = digest(left + h + right)
            proof = digest("".join(a + b for a, b in own + up))
            out.append((r[0], leaf(r), sub, root, proof, h, h == root))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in rows], DOCS)
    for c in ("grp", "idx", "hash", "n", "leaf", "root", "run", "node", "upper"):
        docs = docs.withColumn(c, F.lit("x"))
    got = sorted(map(tuple, merkle.manifest(docs).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_small_trees(spark, n):
    rng = random.Random(n)
    check(spark, [(i, rng.choice([None, "", "a", "é", "Z"]), rng.choice([None, "en"]), i % 7 or None,
                   rng.choice([None, "", "Some Text " + "x" * rng.randrange(90), "ÄA\n😀"])) for i in range(n)])


def test_sources_over_block_borders_ties_and_repeats(spark):
    sizes = {"hot": merkle.BLOCK * 2 + 1, "one": 1, "full": merkle.BLOCK, None: merkle.BLOCK + 16}
    rows = [(i, s, "en", 1, f"Text {i}") for s, n in sizes.items() for i in range(n)]
    rows += [(5, "ties", None, None, t) for t in ("b", "a", "a", None, "")] + [(None, "ties", None, None, "A")] * 3
    rows += [(8, f"s{i:05d}", None, None, "t") for i in range(300)]
    check(spark, rows)


def test_long_text_and_empty_table(spark):
    check(spark, [(0, "s", "en", 1, "Long Text " * 200_000), (1, "s", "en", 1, None)])
    assert merkle.manifest(spark.createDataFrame([], DOCS)).count() == 0
