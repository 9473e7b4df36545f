"""Hard negatives by an STR-packed R-tree over integer vectors.

Sort-tile-recursive packing: the three coordinates of largest spread cut the
rows into tiles (cuts from a sample of at most about ``SAMPLE`` rows, which only
places rows: every row is indexed and the result is exact), a shard of a tile is
packed into pages the same way, and boxes of pages nest up to one root. For a
query each coordinate of a box bounds its products by an interval; their sums
bound the inner products of everything inside. A best-first queue takes the box
with the highest upper end; a box goes when, for every score window still open,
its interval lies outside the window or its upper end strictly below the
window's k-th score. The same intervals between the boxes of query blocks and
shards decide which pairs are visited at all; blocks visit their own tiles
first, whose k-th scores bound the rest.

An anchor's positives are its best rows of the same label; each positive's score
spans a window, and the negatives are the window's best rows of other labels:
two searches with one index, the second with a window per positive.

Edge cases: rows with a null id or label, a null vector or a null or non-finite
component take no part; rows repeating a vec_id count once (smallest label, then
vector); vectors of different lengths meet over the components both have; ties
go to the smaller vec_id (equal bounds are never pruned); a negative positive
score gives an empty window; an anchor without positives or a window without
rows gives no rows, as does an empty table; other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twasprep.llm import vectors
from twasprep.llm.common import materialise
from twasprep.llm.vectors import NONE

SCALE = 256
#: One row in this many is an anchor.
EVERY = 50
POSITIVES = 5
NEGATIVES = 3
#: Per cent of the positive's score between which a negative's lies.
LOW, HIGH = 50, 95
#: Rows whose label moves on by one (of LABELS), by divisor of the id.
SHIFT, LABELS = 7, 10
#: Rows of a shard, rows of a page, boxes of a parent box.
SHARD = 2048
PAGE = 256
FAN = 8
#: Rows that place the tiles' cuts; coordinates that are cut.
SAMPLE = 65536
CUT = 3
FOUND = "query_id long, key long, vec_id long, score long"


def _widest(points: np.ndarray, count: int = CUT) -> np.ndarray:
    spread = points.astype(np.float64).var(axis=0) if len(points) else np.zeros(points.shape[1])
    return np.argsort(-spread, kind="stable")[:count]


def str_order(points: np.ndarray, page: int) -> np.ndarray:
    """Row order of sort-tile-recursive pages of ``page`` rows."""
    dims, order = _widest(points), np.arange(len(points))
    pages = max(1, math.ceil(len(points) / page))
    runs = [order]
    for level, d in enumerate(dims):
        slabs = math.ceil(pages ** (1 / len(dims)))
        unit = page * slabs ** (len(dims) - level - 1)
        cut = []
        for run in runs:
            run = run[np.argsort(points[run, d], kind="stable")]
            cut += [run[i:i + unit] for i in range(0, len(run), unit)]
        runs = cut
    return np.concatenate(runs) if runs else order


def build(ids: np.ndarray, labels: np.ndarray, points: np.ndarray) -> dict[str, np.ndarray]:
    """Pages in STR order with boxes (``lo``, ``hi``) of all levels, the root last.

    Node i covers rows (level 0) or nodes (above) ``first[i]:last[i]``."""
    order = str_order(points, PAGE)
    ids, labels, points = ids[order], labels[order], points[order].astype(np.int32)
    first = np.arange(0, len(ids), PAGE)
    lo, hi = np.minimum.reduceat(points, first, axis=0), np.maximum.reduceat(points, first, axis=0)
    firsts, lasts, los, his = [first], [np.append(first[1:], len(ids))], [lo], [hi]
    leaves, base = len(first), 0
    while len(lo) > 1:
        at = np.arange(0, len(lo), FAN)
        firsts.append(base + at)
        lasts.append(base + np.append(at[1:], len(lo)))
        base += len(lo)
        lo, hi = np.minimum.reduceat(lo, at, axis=0), np.maximum.reduceat(hi, at, axis=0)
        los.append(lo)
        his.append(hi)
    return {"ids": ids, "labels": labels, "points": points, "first": np.concatenate(firsts),
            "last": np.concatenate(lasts), "lo": np.concatenate(los), "hi": np.concatenate(his),
            "leaves": np.array([leaves])}


def intervals(points: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each point with each box.

    A coordinate's interval has its ends at the box's sides, which side by the
    point's sign, so the sums over coordinates are two matrix products each."""
    up, down = np.maximum(points, 0), np.minimum(points, 0)
    return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T


def search_tree(q: dict, d: dict, k: int, same: bool) -> list[tuple[int, int, int, int]]:
    """(query, key, id, score): the best k rows in each window of each query."""
    points, rows = vectors.fit(q["points"], d["points"])
    kind = vectors.exact_type(points, rows)
    points, rows = points.astype(kind), rows.astype(kind)
    width = points.shape[1]
    lo, hi = (np.pad(d[x], ((0, 0), (0, width - d[x].shape[1]))).astype(kind) for x in ("lo", "hi"))
    least, most = intervals(points, lo, hi)
    leaves, root, out = int(d["leaves"][0]), len(lo) - 1, []
    for i in range(len(points)):
        a, b = q["w_at"][i], q["w_at"][i + 1]
        low, high = q["w_lo"][a:b], q["w_hi"][a:b]
        need = np.maximum(low, q["w_floor"][a:b])  # a score below this cannot count
        got: list[list[tuple[int, int]]] = [[] for _ in range(b - a)]
        here, there = most[i], least[i]

        def alive(nodes) -> np.ndarray:
            return ((here[nodes, None] >= need) & (there[nodes, None] <= high)).any(1)

        heap = [(-here[root], root)]
        while heap:
            _, node = heapq.heappop(heap)
            if not ((here[node] >= need) & (there[node] <= high)).any():
                continue
            x, y = d["first"][node], d["last"][node]
            if node >= leaves:
                for child in x + np.flatnonzero(alive(slice(x, y))):
                    heapq.heappush(heap, (-here[child], int(child)))
                continue
            s = rows[x:y] @ points[i]
            others = ((d["labels"][x:y] == q["labels"][i]) == same) & (d["ids"][x:y] != q["ids"][i])
            for w, mine in enumerate(got):
                fits = np.flatnonzero(others & (s >= need[w]) & (s <= high[w]))
                if len(fits) > k:  # the page's own best k
                    fits = fits[np.lexsort((d["ids"][x + fits], -s[fits]))[:k]]
                for j in fits:
                    heapq.heappush(mine, (int(s[j]), -int(d["ids"][x + j])))
                    if len(mine) > k:
                        heapq.heappop(mine)
                if len(mine) == k:
                    need[w] = max(need[w], mine[0][0])
        out += [(int(q["ids"][i]), int(q["w_key"][a + w]), -name, score)
                for w, mine in enumerate(got) for score, name in mine]
    return out


def _tiles(rows: DataFrame, n: int, target: int):
    """Cell function of the sort-tile-recursive cuts."""
    wide = [r["q"] for r in vectors.sample(rows, n, 1024).select("q").collect()]
    size = max((len(q) for q in wide), default=0)
    dims = _widest(np.array([q + [0] * (size - len(q)) for q in wide], np.float64).reshape(len(wide), size))
    at = [F.coalesce(F.get("q", F.lit(int(d))), F.lit(0)).alias(f"x{i}") for i, d in enumerate(dims)]
    picked = [tuple(r) for r in vectors.sample(rows, n, SAMPLE).select(*at).collect()] if at else []
    placed = np.array(picked, np.float64).reshape(len(picked), len(dims))
    tiles = max(1, min(vectors.CELLS, math.ceil(n / target)))
    slabs = max(1, math.ceil(tiles ** (1 / max(1, len(dims)))))
    cuts, cells = [], [placed]
    for i in range(len(dims)):
        at_level, nxt = [], []
        for run in cells:
            run = run[np.argsort(run[:, i], kind="stable")]
            ends = [len(run) * j // slabs for j in range(1, slabs)]
            at_level.append([run[e, i] if len(run) else 0.0 for e in ends])
            nxt += np.split(run, ends)
        cuts.append(np.array(at_level).reshape(len(cells), slabs - 1))
        cells = nxt

    def cell(points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        for d, cut in zip(dims, cuts):
            x = points[:, d] if d < points.shape[1] else np.zeros(len(points))
            out = out * slabs + (x[:, None] >= cut[out]).sum(1)
        return out

    return cell


def _build_shard(key: tuple, rows: pa.Table) -> pa.Table:
    t = build(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), vectors.dense(rows["q"]))
    return pa.table({"shard": [key[0].as_py()], "lo": [t["lo"][-1].astype(np.float64).tolist()],
                     "hi": [t["hi"][-1].astype(np.float64).tolist()], "blob": [vectors.pack(**t)]})


def _build_block(key: tuple, rows: pa.Table) -> pa.Table:
    windows = rows["windows"].combine_chunks()
    flat = windows.flatten()
    low, high, floor = (flat.field(c).to_numpy() for c in ("lo", "hi", "floor"))
    points = vectors.dense(rows["q"])
    blob = vectors.pack(ids=rows["query_id"].to_numpy(), labels=rows["label"].to_numpy(), points=points,
                        w_at=np.concatenate([[0], np.cumsum(windows.value_lengths().to_numpy())]),
                        w_key=flat.field("key").to_numpy(), w_lo=low, w_hi=high, w_floor=floor)
    return pa.table({"block": [key[0].as_py()], "q_lo": [points.min(0).astype(np.float64).tolist()],
                     "q_hi": [points.max(0).astype(np.float64).tolist()],
                     "least": [int(np.maximum(low, floor).min())], "most": [int(high.max())], "blob": [blob]})


def _search(k: int, same: bool):
    def search(q: dict | None, d: dict | None) -> pa.Table:
        found = [] if q is None else search_tree(q, d, k, same)
        columns = list(zip(*found)) or [[], [], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "key", "vec_id", "score"), columns)})
    return search


def _ends() -> tuple[Column, Column]:
    """Least and largest product between a block's box and a shard's box."""
    sides = F.zip_with(F.arrays_zip("q_lo", "q_hi"), F.arrays_zip("lo", "hi"), lambda a, b: F.array(
        *[F.coalesce(x * y, F.lit(0.0)) for x in (a["q_lo"], a["q_hi"]) for y in (b["lo"], b["hi"])]))
    total = lambda pick: F.aggregate(sides, F.lit(0.0), lambda s, x: s + pick(x))
    return total(F.array_min) - 1.0, total(F.array_max) + 1.0


def best(found: DataFrame, k: int) -> DataFrame:
    """The k first of each window: higher scores, then smaller ids."""
    order = Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(queries: DataFrame, shards: DataFrame, k: int, same: bool) -> DataFrame:
    """Best ``k`` rows (same label or another) in every window of every query.

    ``queries``: query_id, block, cell, label, q, windows (key, lo, hi)."""
    n_blocks = max(1, (queries.agg(F.max("block")).first()[0] or 0) + 1)
    packed = "block long, q_lo array<double>, q_hi array<double>, least long, most long, blob binary"
    window = lambda w, floor: F.struct(w["key"].alias("key"), w["lo"].alias("lo"), w["hi"].alias("hi"),
                                       floor.alias("floor"))
    none = F.lit(NONE).cast("long")
    blocks = materialise(queries.select("block", "query_id", "label", "q", F.transform(
        "windows", lambda w: window(w, none)).alias("windows")).groupBy("block").applyInArrow(
        _build_block, packed), "rtree-blocks")
    own = queries.select("block", (F.col("cell").cast("long") * 2 ** 32).alias("shard")).distinct()
    first = materialise(best(vectors.visit(own, blocks, shards, _search(k, same), FOUND), k), "rtree-first")
    kth = first.groupBy("query_id", "key").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).where(
        F.col("n") >= k).groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "s"))).alias("kth"))
    again = queries.join(kth, "query_id", "left").select("block", "query_id", "label", "q", F.transform(
        "windows", lambda w: window(w, F.coalesce(F.try_element_at("kth", w["key"]), none))).alias("windows"))
    blocks = materialise(again.groupBy("block").applyInArrow(_build_block, packed), "rtree-blocks")
    least, most = _ends()
    rest = vectors.all_pairs(blocks.drop("blob"), shards.drop("blob"), n_blocks).where(
        (most >= F.col("least")) & (least <= F.col("most"))).select("block", "shard").join(
        own, ["block", "shard"], "left_anti")
    later = vectors.visit(rest, blocks, shards, _search(k, same), FOUND)
    return best(first.drop("rank").unionByName(later), k)


def _share(score: Column, percent: int, up: bool) -> Column:
    """percent * score / 100 rounded up or down, in decimals (a long could overflow)."""
    share = score.cast("decimal(20,0)") * F.lit(percent).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")
    return (F.ceil(share) if up else F.floor(share)).cast("long")


def hard_negatives(rows: DataFrame, scale: int = SCALE, every: int = EVERY, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, vec_col: str = "embedding",
                   shard_rows: int = SHARD, block_rows: int = vectors.BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % SHIFT == 0, (label + 1) % LABELS).otherwise(label)
    rows = vectors.integer_vectors(rows.where("label is not null"), scale, vec_col, moved.alias("label"))
    rows = materialise(rows, "rtree-rows")
    placed = materialise(vectors.in_cells(rows, _tiles(rows, rows.count(), shard_rows)), "rtree-tiles")
    shards = materialise(vectors.shard_of(placed, shard_rows).groupBy("shard").applyInArrow(
        _build_shard, "shard long, lo array<double>, hi array<double>, blob binary"), "rtree-shards")
    anchors = placed.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    anchors = materialise(vectors.block_of(anchors, block_rows), "rtree-anchors")
    bound = F.lit(-NONE).cast("long")
    whole = F.struct(F.lit(0).cast("long").alias("key"), F.lit(NONE).cast("long").alias("lo"), bound.alias("hi"))
    found = materialise(search(anchors.withColumn("windows", F.array(whole)), shards, positives, True).select(
        "query_id", F.col("vec_id").alias("key"), F.col("score").alias("positive_score")), "rtree-positives")
    score = F.col("positive_score")
    window = F.struct("key", _share(score, low, True).alias("lo"), _share(score, high, False).alias("hi"))
    windows = found.where(score >= 0).groupBy("query_id").agg(F.collect_list(window).alias("windows"))
    mined = search(anchors.join(windows, "query_id"), shards, negatives, False)
    return mined.join(found, ["query_id", "key"]).select(
        F.col("query_id").alias("anchor_id"), F.col("key").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
