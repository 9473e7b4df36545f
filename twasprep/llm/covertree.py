"""Exact top-k inner-product search by dual cover trees.

The rows are cut into cells around pivots (rows picked by hash, a sample of at
most about ``CELLS`` rows that only places rows: every row is indexed and the
result is exact) and each shard of a cell is built into a cover tree: a
node's children are a net of half its scale that covers its points, and each
node keeps its covering radius. The queries of a block get a tree of their own.
A block and a shard are searched together, best pair of nodes first: no score
between two nodes exceeds

    <c, d> + r |d| + s |c| + r s        (centres c, d, covering radii r, s)

and a pair goes when this lies strictly below the worst k-th score of the query
node's group. The same bound between whole blocks and shards decides before
anything is shipped which pairs are visited at all: blocks first visit the
shards of their own queries' cells, whose k-th scores bound the others.

Edge cases: rows with a null id, a null vector or a null or non-finite component
take no part; rows repeating a vec_id count once (smallest vector); vectors of
different lengths are compared over the components both have, so an empty one
scores 0; ties go to the smaller vec_id (equal bounds are never pruned); with
fewer rows than k all are returned; an empty table or query set gives no rows;
other columns are not read.
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

K = 10
SCALE = 1024
#: One row in this many is a query.
EVERY = 100
#: Rows of a shard.
SHARD = 2048
#: Points below which a node is not split.
LEAF = 32
FOUND = "query_id long, vec_id long, score long"


class CoverTree:
    """Nodes over ``points``; a node's points are the slice start:end of ``order``."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.start, self.end, self.center, self.radius, self.children = [], [], [], [], []
        if len(points):
            p = points.astype(np.float64)
            self._grow(p, 0, len(p), 0, np.sqrt(((p - p[0]) ** 2).sum(1)))
        self.norm = [float(np.sqrt((points[c].astype(np.float64) ** 2).sum())) for c in self.center]

    def _node(self, start: int, end: int, center: int, radius: float) -> int:
        self.start.append(start)
        self.end.append(end)
        self.center.append(center)
        self.radius.append(radius)
        self.children.append([])
        return len(self.start) - 1

    def _grow(self, p: np.ndarray, start: int, end: int, center: int, dist: np.ndarray) -> None:
        """Nets of half the scale, node by node (no recursion: depth is data's)."""
        work = [(self._node(start, end, center, float(dist.max(initial=0.0))), dist)]
        while work:
            node, dist = work.pop()
            a, b, far = self.start[node], self.end[node], self.radius[node]
            if b - a <= LEAF or far <= 0.0:
                continue
            cover = 2.0 ** (math.ceil(math.log2(far)) - 1)
            left, gap, nets, c = self.order[a:b].copy(), dist, [], self.center[node]
            while len(left):
                near = gap <= cover
                nets.append((c, left[near], gap[near]))
                left = left[~near]
                if len(left):
                    c = int(left[np.argmax(gap[~near])])
                    gap = np.sqrt(((p[left] - p[c]) ** 2).sum(1))
            # children that hold their centre alone share one leaf under the parent's centre
            alone = [n for n in nets if len(n[1]) == 1]
            at = a
            for c, own, gap in (n for n in nets if len(n[1]) > 1):
                self.order[at:at + len(own)] = own
                child = self._node(at, at + len(own), c, float(gap.max()))
                self.children[node].append(child)
                work.append((child, gap))
                at += len(own)
            if alone:
                self.order[at:b] = [n[0] for n in alone]
                self.children[node].append(self._node(at, b, self.center[node], far))

    def arrays(self) -> dict[str, np.ndarray]:
        """Flat form; the children of a node are ``kids[first:first + count]``."""
        count = np.array([len(c) for c in self.children], np.int64)
        return {"order": self.order, "start": np.array(self.start, np.int64), "end": np.array(self.end, np.int64),
                "center": np.array(self.center, np.int64), "radius": np.array(self.radius),
                "norm": np.array(self.norm), "count": count, "first": np.cumsum(count) - count,
                "kids": np.array([x for c in self.children for x in c], np.int64)}


def tree_of(ids: np.ndarray, points: np.ndarray) -> dict[str, np.ndarray]:
    """Tree arrays with ids and points in tree order, and the centres' vectors."""
    t = CoverTree(points).arrays()
    order = t.pop("order")
    return t | {"ids": ids[order], "points": points[order].astype(np.int32),
                "centers": points[t.pop("center")].astype(np.int32)}


def dual_search(q: dict, d: dict, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best k (score, id) of every query in ``q`` among ``d``'s rows that reach its floor."""
    points, rows = vectors.fit(q["points"], d["points"])
    kind = vectors.exact_type(points, rows)
    points, rows = points.astype(kind), rows.astype(kind)
    qc, dc = (x.astype(np.float64) for x in vectors.fit(q["centers"], d["centers"]))
    n = len(points)
    top = np.full((n, k), NONE, np.int64)
    who = np.full((n, k), np.iinfo(np.int64).max, np.int64)
    kth = floors.copy()
    kids = [t["kids"][f:f + c] for t in (q, d) for f, c in zip(t["first"], t["count"])]
    q_kids, d_kids = kids[:len(q["first"])], kids[len(q["first"]):]
    # rounding of the float bounds never prunes: they are widened by more than their error
    slack = 1.0 + 1e-9 * (q["norm"].max() + q["radius"].max()) * (d["norm"].max() + d["radius"].max())

    def bounds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (qc[a] @ dc[b].T + q["radius"][a][:, None] * (d["norm"][b] + d["radius"][b])[None]
                + q["norm"][a][:, None] * d["radius"][b][None] + slack)

    heap = [(-float(bounds(np.array([0]), np.array([0]))[0, 0]), 0, 0)]
    while heap:
        best, a, b = heapq.heappop(heap)
        lo, hi = q["start"][a], q["end"][a]
        if -best < kth[lo:hi].min():
            continue
        x, y = q_kids[a], d_kids[b]
        if not len(x) and not len(y):
            s = points[lo:hi] @ rows[d["start"][b]:d["end"][b]].T
            ids = d["ids"][d["start"][b]:d["end"][b]]
            good = (s >= kth[lo:hi, None]) & (ids[None] != q["ids"][lo:hi, None])
            use, cols = np.flatnonzero(good.any(1)), np.flatnonzero(good.any(0))
            if not len(use):
                continue
            here = lo + use
            part = np.where(good[np.ix_(use, cols)], s[np.ix_(use, cols)].astype(np.int64), NONE)
            score = np.concatenate([top[here], part], 1)
            name = np.concatenate([who[here], np.broadcast_to(ids[cols], part.shape)], 1)
            first = np.lexsort((name, -score), axis=1)[:, :k]
            top[here] = np.take_along_axis(score, first, 1)
            who[here] = np.take_along_axis(name, first, 1)
            kth[here] = np.maximum(kth[here], top[here, k - 1])
            continue
        # split the wider of the two, or the one that can be split
        split_q = len(x) and (not len(y) or q["radius"][a] >= d["radius"][b])
        left, right = (x, np.array([b])) if split_q else (np.array([a]), y)
        table = bounds(left, right)
        for i, u in enumerate(left):
            least = kth[q["start"][u]:q["end"][u]].min()
            for j in np.flatnonzero(table[i] >= least):
                heapq.heappush(heap, (-float(table[i, j]), int(u), int(right[j])))
    return top, who


def _pivots(rows: DataFrame, n: int, target: int) -> np.ndarray:
    """Vectors picked by id hash: about one per ``target`` rows, at most about CELLS; else the origin."""
    p = max(1, min(vectors.CELLS, math.ceil(n / target)))
    picked = [r["q"] for r in vectors.sample(rows, n, p).orderBy("vec_id").select("q").collect()] or [[]]
    width = max(len(q) for q in picked)
    return np.array([q + [0] * (width - len(q)) for q in picked], np.float64).reshape(len(picked), width)


def _nearest(pivots: np.ndarray):
    def cell(points: np.ndarray) -> np.ndarray:
        x, p = vectors.fit(points.astype(np.float64), pivots)
        return ((p ** 2).sum(1)[None] - 2.0 * (x @ p.T)).argmin(1)
    return cell


def _build_shard(key: tuple, rows: pa.Table) -> pa.Table:
    t = tree_of(rows["vec_id"].to_numpy(), vectors.dense(rows["q"]))
    return pa.table({"shard": [key[0].as_py()], "center": [t["centers"][0].astype(np.float64).tolist()],
                     "norm": [float(t["norm"][0])], "radius": [float(t["radius"][0])], "blob": [vectors.pack(**t)]})


def _build_block(key: tuple, rows: pa.Table) -> pa.Table:
    ids, floors = rows["query_id"].to_numpy(), rows["floor"].to_numpy()
    t = tree_of(ids, vectors.dense(rows["q"]))
    t["floors"] = floors[np.argsort(ids)][np.searchsorted(np.sort(ids), t["ids"])]
    return pa.table({"block": [key[0].as_py()], "q_center": [t["centers"][0].astype(np.float64).tolist()],
                     "q_norm": [float(t["norm"][0])], "q_radius": [float(t["radius"][0])],
                     "least": [int(floors.min())], "blob": [vectors.pack(**t)]})


def _search(k: int):
    def search(q: dict | None, d: dict | None) -> pa.Table:
        if q is None:
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        top, who = dual_search(q, d, q["floors"], k)
        hit = top > NONE
        return pa.table({"query_id": np.repeat(q["ids"], hit.sum(1)), "vec_id": who[hit], "score": top[hit]})
    return search


def best(found: DataFrame, k: int) -> DataFrame:
    """The k first of each query: higher scores, then smaller ids."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _bound() -> Column:
    """The node bound between a whole block and a whole shard."""
    dot = F.aggregate(F.zip_with("q_center", "center", lambda a, b: F.coalesce(a * b, F.lit(0.0))), F.lit(0.0),
                      lambda s, x: s + x)
    reach = (F.col("q_norm") + F.col("q_radius")) * (F.col("norm") + F.col("radius"))
    return (dot + F.col("q_radius") * (F.col("norm") + F.col("radius")) + F.col("q_norm") * F.col("radius")
            + F.lit(1.0) + F.lit(1e-9) * reach)


def top_k(rows: DataFrame, k: int = K, scale: int = SCALE, every: int = EVERY, vec_col: str = "embedding",
          shard_rows: int = SHARD, block_rows: int = vectors.BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of the best ``k`` rows for every query row."""
    rows = materialise(vectors.integer_vectors(rows, scale, vec_col), "cover-rows")
    pivots = _pivots(rows, rows.count(), shard_rows)
    placed = materialise(vectors.in_cells(rows, _nearest(pivots)), "cover-cells")
    shards = materialise(vectors.shard_of(placed, shard_rows).groupBy("shard").applyInArrow(
        _build_shard, "shard long, center array<double>, norm double, radius double, blob binary"), "cover-shards")
    queries = placed.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    queries = materialise(vectors.block_of(queries, block_rows), "cover-queries")
    n_blocks = max(1, (queries.agg(F.max("block")).first()[0] or 0) + 1)

    def packed(with_floors: DataFrame, tag: str) -> DataFrame:
        return materialise(with_floors.groupBy("block").applyInArrow(
            _build_block, "block long, q_center array<double>, q_norm double, q_radius double, least long, blob binary"),
            tag)

    no_floor = F.lit(NONE).cast("long").alias("floor")
    blocks = packed(queries.select("block", "query_id", "q", no_floor), "cover-blocks")
    own = queries.select("block", (F.col("cell").cast("long") * 2 ** 32).alias("shard")).distinct()
    first = materialise(best(vectors.visit(own, blocks, shards, _search(k), FOUND), k), "cover-first")
    floors = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).where(
        F.col("n") >= k).select("query_id", F.col("s").alias("floor"))
    again = queries.join(floors, "query_id", "left").select(
        "block", "query_id", "q", F.coalesce("floor", F.lit(NONE).cast("long")).alias("floor"))
    blocks = packed(again, "cover-blocks")
    bounds = blocks.drop("blob"), shards.drop("blob")
    rest = vectors.all_pairs(*bounds, n_blocks).where(_bound() >= F.col("least")).select("block", "shard").join(
        own, ["block", "shard"], "left_anti")
    later = vectors.visit(rest, blocks, shards, _search(k), FOUND)
    both = first.select("query_id", "vec_id", "score").unionByName(later)
    return best(both, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
