"""Vector searches (R-tree hard negatives, dual cover trees) against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from twasprep.llm import covertree, rtree, vectors

ROWS = "vec_id bigint, embedding array<float>, label int"


def exact(rows, scale, need_label):
    """{vec_id: (label, integer vector)} of the rows that take part, first of equals."""
    out = {}
    for i, v, label in rows:
        if i is None or v is None or (need_label and label is None):
            continue
        if any(x is None or not math.isfinite(x) for x in v):
            continue
        if need_label and i % rtree.SHIFT == 0:
            label = (label + 1) % rtree.LABELS
        new = (label if need_label else 0, [math.floor(scale * float(np.float32(x))) for x in v])
        out[i] = min(out.get(i, new), new)
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def first(pairs, k):
    return sorted(pairs, key=lambda p: (-p[1], p[0]))[:k]


def brute_top(rows, k=covertree.K, every=covertree.EVERY):
    t = exact(rows, covertree.SCALE, False)
    return sorted((q, r + 1, i, s) for q in t if q % every == 0 for r, (i, s) in enumerate(
        first([(i, dot(t[q][1], v)) for i, (_, v) in t.items() if i != q], k)))


def brute_mine(rows, every=rtree.EVERY):
    t, out = exact(rows, rtree.SCALE, True), []
    for a in (x for x in t if x % every == 0):
        label, q = t[a]
        scored = [(i, dot(q, v), lab) for i, (lab, v) in t.items() if i != a]
        for p, ps in first([(i, s) for i, s, lab in scored if lab == label], rtree.POSITIVES):
            good = [(i, s) for i, s, lab in scored if lab != label and 50 * ps <= 100 * s <= 95 * ps]
            out += [(a, p, r + 1, i, ps, s) for r, (i, s) in enumerate(first(good, rtree.NEGATIVES))]
    return sorted(out)


def frame(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    for c in ("q", "cell", "shard", "block", "floor", "rank", "score", "windows", "key", "query_id"):
        df = df.withColumn(c, F.lit("x"))
    return df


def gaussian(n, dims, seed, clusters=None):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(clusters, dims)) if clusters else np.zeros((1, dims))
    at = rng.integers(len(middle), size=n)
    x = middle[at] + rng.normal(scale=0.2 if clusters else 0.3, size=(n, dims))
    return [(i, [float(np.float32(y)) for y in v], int(rng.integers(10))) for i, v in enumerate(x)]


CASES = {
    "gaussian": gaussian(700, 12, 1),
    "clusters": gaussian(900, 6, 2, clusters=9),
    # a third of all rows is one vector: ties all over, a hot tile, a net of radius 0
    "hot": [(i, [0.5, -0.25, 1.0] if i % 3 == 0 else [i / 700, 1 - i / 300, (i % 17) / 9], i % 4)
            for i in range(600)],
    "odd": [(0, [1.0, 2.0], 1), (50, [1.0], 1), (100, [], 2), (150, [0.0, -0.0], 1), (200, None, 1),
            (250, [None, 1.0], 1), (300, [float("nan"), 1.0], 1), (350, [float("inf")], 2), (None, [1.0, 1.0], 1),
            (400, [2.0, 2.0], None), (7, [1.5, 1.0], 0), (1, [1.0, 0.9], 1), (2, [1.0, 0.9], 3), (2, [1.0, 0.9], 3),
            (2, [0.5, 0.5], 3), (100, [3.0, 1.0], 1), (-50, [-1.0, -1.0], 1), (3, [2 ** 14 / 1.0, 1.0], 2)],
    "one": [(0, [0.5, 0.5], 1)],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_top_k_equals_brute_force(spark, case):
    got = covertree.top_k(frame(spark, CASES[case]), shard_rows=128, block_rows=3)
    assert sorted(map(tuple, got.collect())) == brute_top(CASES[case])


@pytest.mark.parametrize("case", sorted(CASES))
def test_hard_negatives_equal_brute_force(spark, case):
    got = rtree.hard_negatives(frame(spark, CASES[case]), shard_rows=128, block_rows=5)
    assert sorted(map(tuple, got.collect())) == brute_mine(CASES[case])


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="lies beyond"):
        vectors.integer_vectors(spark.createDataFrame([(0, [3e38], 1)], ROWS), 256, "embedding").collect()


def test_cover_tree_invariants_and_pruning():
    rng = np.random.default_rng(3)
    points = (1000 * (rng.normal(size=(40, 3))[rng.integers(40, size=3000)] + rng.normal(scale=.01, size=(3000, 3))))
    points = points.astype(np.int64)
    t = covertree.tree_of(np.arange(3000), points)
    assert sorted(t["ids"]) == list(range(3000)) and t["end"][0] == 3000
    for i, (a, b) in enumerate(zip(t["start"], t["end"])):
        far = np.sqrt(((t["points"][a:b].astype(float) - t["centers"][i]) ** 2).sum(1)).max()
        assert far <= t["radius"][i] + 1e-6
        kids = t["kids"][t["first"][i]:t["first"][i] + t["count"][i]]
        if len(kids):  # children cover their parent's slice without gaps
            assert sorted(x for k in kids for x in range(t["start"][k], t["end"][k])) == list(range(a, b))
    # a floor nobody reaches prunes the root pair: nothing is found
    top, _ = covertree.dual_search(t, t, np.full(3000, 2 ** 50), 3)
    assert (top == vectors.NONE).all()


def test_boxes_hold_their_rows_and_bound_every_product():
    rng = np.random.default_rng(4)
    points = rng.integers(-300, 300, size=(2500, 5))
    t = rtree.build(np.arange(2500), np.zeros(2500, int), points)
    q = rng.integers(-300, 300, size=(20, 5))
    least, most = rtree.intervals(q, t["lo"].astype(np.int64), t["hi"].astype(np.int64))
    for node in range(int(t["leaves"][0])):
        own = t["points"][t["first"][node]:t["last"][node]].astype(np.int64)
        assert (own >= t["lo"][node]).all() and (own <= t["hi"][node]).all()
        s = q @ own.T
        assert (s.min(1) >= least[:, node]).all() and (s.max(1) <= most[:, node]).all()
    assert (t["lo"][-1] == points.min(0)).all() and (t["hi"][-1] == points.max(0)).all()
