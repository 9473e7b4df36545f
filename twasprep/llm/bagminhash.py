"""Near-duplicate classes by BagMinHash over multisets of five-word shingles.

Signatures: every element carries Poisson processes over its weight axis, cut
into the dyadic ranges [0,1), [1,2), [2,4), ... and split hierarchically down
to unit weights; a point (time, component) counts for a text whose count of the
element covers the point's range. Component j of the signature is the earliest
time of any counted point with that component: two texts agree in a component
with probability equal to their weighted Jaccard similarity. Points later than
the largest component so far can't matter and are never drawn.

Candidates share one of 32 bands of 4 components (a pair at similarity 0.8 is
missed with chance 5e-8). Each bucket is compared with its least member first,
then along random chains while that joins classes (copies never form all
pairs); at last the pairs that are still in different classes are compared
unless a proof rules a link out: the triangle inequality of the Jaccard distance,
or a parity sketch that bounds the multisets' difference from below.
Pairs are listed bucket by bucket only in buckets of up to ``WIDE`` members, so a
text costs a bounded number of comparisons whatever the bucket. The texts of wider
ones meet over their rarest elements instead: with the elements
of all these texts in one order, rarest first, texts of similarity t share one of
the first |x| - t |x| + 1 elements of each (prefix filtering, which loses none),
so texts that have a template in common but not four fifths of it form no pairs.
Every link is verified on the exact multisets; the
classes are the connected components of all links.

Equal texts are one node throughout (keyed by md5): one signature for each task
that reads copies of a text, one band list in the search, and no pairs.

Edge cases: null counts as empty text; texts without words are grouped only
with equal texts; a text of fewer than five words is one shingle; repeated rows
and ids are kept, one result row per input row; a null id sorts first and stays
null; an empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from twasprep.llm import textvec as tv
from twasprep.llm.common import materialise

U = tv.U
COMPONENTS, BAND_ROWS = 128, 4
SHINGLE = 5
SKETCH = 1024  # parity bits per text
WIDE = 2048  # members of a bucket up to which its pairs are listed
HEADS = 32  # first prefix elements that travel with each, to form a pair once
CHAINS = 2  # passes over unsettled buckets before the remaining pairs are compared
BLOCK = 1 << 21
#: Similarity threshold as a fraction, so that the comparison is exact.
NUM, DEN = 4, 5


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1) from 64 random bits."""
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def signatures(e: np.ndarray, row: np.ndarray, count: np.ndarray, n_rows: int,
               m: int = COMPONENTS) -> np.ndarray:
    """Float matrix (n_rows, m); rows without elements stay infinite."""
    h = np.full(n_rows * m, np.inf)
    # roots: one node per element and dyadic range that its count reaches
    seeds, rows, cnt, lo, width = [], [], [], [], []
    level, at = 0, np.arange(len(e))
    while len(at):
        low = 0 if level == 0 else 1 << (level - 1)
        at = at[count[at] > low]
        seeds.append(tv.mix(e[at] + U((0x9E3779B97F4A7C15 * (level + 1)) & (2 ** 64 - 1))))
        rows.append(row[at])
        cnt.append(count[at])
        lo.append(np.full(len(at), low))
        width.append(np.full(len(at), 1 if level == 0 else low))
        level += 1
    if not seeds:
        return h.reshape(n_rows, m)
    seed, r, c, lo, w = (np.concatenate(x) for x in (seeds, rows, cnt, lo, width))
    x = np.zeros(len(seed))
    comp = np.zeros(len(seed), np.int64)
    fresh = np.ones(len(seed), bool)  # needs its next point
    while len(seed):
        # next points of fresh nodes
        f = np.flatnonzero(fresh)
        seed[f] = tv.mix(seed[f] + U(0x632BE59BD9B4E019))
        x[f] -= np.log(_unit(seed[f])) / w[f]
        comp[f] = (tv.mix(seed[f] ^ U(0xD6E8FEB86659FD93)) % U(m)).astype(np.int64)
        full = f[lo[f] + w[f] <= c[f]]
        np.minimum.at(h, r[full] * m + comp[full], x[full])
        limit = h.reshape(n_rows, m).max(axis=1)
        keep = x <= limit[r]
        seed, r, c, lo, w, x, comp = (a[keep] for a in (seed, r, c, lo, w, x, comp))
        fresh = w == 1
        s = np.flatnonzero(~fresh)
        if len(s):
            # split: the half that holds the point keeps it, the other draws its own later one
            half = w[s] // 2
            right = (tv.mix(seed[s] ^ U(0xA5A3564E1E2F9B17)) >> U(63)).astype(bool)
            kids = []
            for side in (0, 1):
                sd = tv.mix(seed[s] + U(0x2545F4914F6CDD1D * (side + 1) & (2 ** 64 - 1)))
                holds = right == bool(side)
                kids.append((sd, r[s], c[s], lo[s] + side * half, half, x[s], comp[s], holds))
            sd, kr, kc, kl, kw, kx, kk, holds = (np.concatenate(z) for z in zip(*kids))
            ok = kl < kc
            sd, kr, kc, kl, kw, kx, kk, holds = (a[ok] for a in (sd, kr, kc, kl, kw, kx, kk, holds))
            full = np.flatnonzero(holds & (kl + kw <= kc))
            np.minimum.at(h, kr[full] * m + kk[full], kx[full])
            # a half that holds the point is split on, or goes on once it has unit width
            base = np.flatnonzero(fresh)
            seed, r, c, lo, w, x, comp, fresh = (
                np.concatenate((a[base], b)) for a, b in (
                    (seed, sd), (r, kr), (c, kc), (lo, kl), (w, kw), (x, kx), (comp, kk),
                    (fresh, (~holds) | (kw == 1))))
    return h.reshape(n_rows, m)


def _bag_rows(batch: pa.RecordBatch, text: str):
    """Blocks of (row range, element, row, count) of a batch."""
    buf, off = tv.utf8(batch.column(text))
    for lo, hi in tv.blocks(off, BLOCK):
        o = off[lo:hi + 1] - off[lo]
        w, row = tv.word_hashes(buf[off[lo]:off[hi]], o)
        yield lo, hi, *tv.occurrences(*tv.shingles(w, row, SHINGLE))


def _first_copies(batches):
    """Batches without the rows whose text the task has met before."""
    met: set[bytes] = set()
    for batch in batches:
        new = []
        for key in batch.column("tkey").to_pylist():
            new.append(key not in met)
            met.add(key)
        yield batch if all(new) else batch.filter(pa.array(new))


def _band_batches(batches):
    for batch in _first_copies(batches):
        for lo, hi, e, row, cnt in _bag_rows(batch, "text"):
            sig = signatures(e, row, cnt, hi - lo)
            some = np.isfinite(sig[:, 0])
            bits = np.ascontiguousarray(sig[some]).view(U)
            nb = COMPONENTS // BAND_ROWS
            band = np.broadcast_to(np.arange(nb).astype(U), (len(bits), nb))
            for j in range(BAND_ROWS):
                band = tv.mix(band * U(0x9E3779B97F4A7C15) + bits[:, j::BAND_ROWS])
            keys = batch.column("tkey").slice(lo, hi - lo).filter(pa.array(some))
            flat = pa.array(np.ascontiguousarray(band).view(np.int64).ravel())
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(bits) + 1, dtype=np.int32) * nb), flat)
            yield pa.RecordBatch.from_arrays([keys, lists], ["tkey", "bands"])


def _set_batches(batches):
    """(tkey, bag): the multiset as the set of hashes of (element, occurrence number)."""
    for batch in batches:
        for lo, hi, e, row, cnt in _bag_rows(batch, "text"):
            total = int(cnt.sum())
            nth = np.arange(total) - np.repeat(np.cumsum(cnt) - cnt, cnt)
            flat = tv.mix(np.repeat(e, cnt) + nth.astype(U) * U(0x632BE59BD9B4E019))
            sizes = np.bincount(np.repeat(row, cnt), minlength=hi - lo)
            off = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(off), pa.array(flat.view(np.int64)))
            # parity of the element count in each of SKETCH hashed groups
            group = np.repeat(row, cnt) * SKETCH + (flat % U(SKETCH)).astype(np.int64)
            odd = np.bincount(group, minlength=(hi - lo) * SKETCH) & 1
            bits = np.packbits(odd.astype(np.uint8).reshape(hi - lo, SKETCH), axis=1).view(np.int64)
            sketch = pa.ListArray.from_arrays(
                pa.array(np.arange(hi - lo + 1, dtype=np.int32) * (SKETCH // 64)),
                pa.array(np.ascontiguousarray(bits).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("tkey").slice(lo, hi - lo), lists, sketch], ["tkey", "bag", "sketch"])


def _apart(x: str, y: str):
    """A lower bound of the number of elements in which two multisets differ:
    a group whose parity differs holds at least one of them."""
    return sum((F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i))))
                for i in range(1, SKETCH // 64)), F.bit_count(
                    F.get(x, F.lit(0)).bitwiseXOR(F.get(y, F.lit(0)))))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of an undirected graph given as (a, b): comp is the least node.

    Least labels spread along edges and then jump to their own label's label;
    every round is written to the shared folder. The loop ends when no label
    changes.
    """
    both = materialise(edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "graph")
    labels = materialise(both.groupBy("a").agg(
        F.least(F.col("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(
            F.min("comp").alias("near"))
        spread = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = labels.select(F.col("node").alias("up"), F.col("comp").alias("up_comp"))
        new = materialise(spread.join(up, spread["comp"] == up["up"]).select(
            "node", "old", F.least("comp", "up_comp").alias("comp")), "labels")
        changed = not new.where("old <> comp").isEmpty()
        labels = new.select("node", "comp")
        if not changed:
            return labels


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       F.unhex(F.md5(text)).alias("tkey"))


def _similar(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """(a, b, inter, uni): exact multiset overlap of each pair of nodes."""
    x = pairs.join(bags.select(F.col("tkey").alias("a"), F.col("bag").alias("bag_a")), "a")
    y = x.join(bags.select(F.col("tkey").alias("b"), F.col("bag").alias("bag_b")), "b")
    inter = F.size(F.array_intersect("bag_a", "bag_b"))
    return y.select("a", "b", inter.alias("inter"), (F.size("bag_a") + F.size("bag_b")).alias("sum")) \
        .select("a", "b", "inter", (F.col("sum") - F.col("inter")).alias("uni"))


def near_duplicate_links(docs: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(links between distinct texts (a, b), their classes (node, comp))."""
    keyed = _keyed(docs, id_col, text_col)
    bands = materialise(keyed.select("tkey", "text").mapInArrow(
        _band_batches, "tkey binary, bands array<bigint>").dropDuplicates(["tkey"]), "bands")
    rows = bands.select("tkey", F.explode("bands").alias("band"))
    several = rows.groupBy("band").agg(F.min("tkey").alias("pivot"), F.max("tkey").alias("other")) \
        .where("pivot <> other").drop("other")
    pivoted = rows.join(several, "band").select("band", "tkey", "pivot")
    members = materialise(pivoted, "members")
    pairs = members.where("tkey <> pivot").select(
        F.col("tkey").alias("a"), F.col("pivot").alias("b")).distinct()
    nodes = members.select("tkey").distinct()
    reps = keyed.groupBy("tkey").agg(F.min("doc_id").alias("rep"))
    wanted = nodes.join(reps, "tkey")
    texts = keyed.join(wanted.withColumnRenamed("tkey", "k"),
                       (keyed["tkey"] == F.col("k")) & keyed["doc_id"].eqNullSafe(F.col("rep"))) \
        .select("tkey", "text")
    bags = materialise(texts.mapInArrow(_set_batches, "tkey binary, bag array<bigint>, sketch array<bigint>")
                       .dropDuplicates(["tkey"]), "bags")
    star = materialise(_similar(pairs, bags), "star")
    linked = F.col("inter") * DEN >= F.col("uni") * NUM
    links = star.where(linked).select("a", "b")
    links = materialise(links, "links")
    comps = components(links)
    base = materialise(members.join(star.select(
        F.col("a").alias("tkey"), F.col("b").alias("pivot"),
        (1.0 - F.col("inter") / F.col("uni")).alias("far")), ["tkey", "pivot"], "left")
        .select("band", "tkey", F.coalesce("far", F.lit(0.0)).alias("far")), "base")
    # chains: neighbours in a random order of each bucket that still has several
    # classes, as long as this joins classes (a pass is linear in the members)
    for turn in range(CHAINS):
        placed = _unsettled(base, comps)
        order = Window.partitionBy("band").orderBy(F.xxhash64(F.lit(turn), "tkey"), "tkey")
        chain = placed.select("tkey", "comp", F.lag("tkey").over(order).alias("t"),
                              F.lag("comp").over(order).alias("c")).where("comp <> c") \
            .select(F.greatest("tkey", "t").alias("a"), F.least("tkey", "t").alias("b")).distinct()
        more = materialise(_similar(chain, bags).where(linked).select("a", "b"), "chain")
        if more.isEmpty():
            break
        links = materialise(links.unionByName(more), "links")
        comps = components(links)
    # what is left: members outside the largest class of their bucket against
    # the members of other classes, unless the triangle inequality over the
    # pivot or the parity sketch proves that they differ by more than a link
    placed = _unsettled(base, comps)
    heads = placed.groupBy("band", "comp").count().groupBy("band").agg(
        F.max(F.struct("count", "comp"))["comp"].alias("head"))
    placed = placed.join(heads, "band").join(
        bags.select("tkey", F.size("bag").alias("size"), "sketch"), "tkey")
    # the unsettled bands of each member (at most one per band index), in order:
    # a pair is formed in its first common bucket only
    shared = placed.groupBy("tkey").agg(F.array_sort(F.collect_set("band")).alias("bands"))
    placed = materialise(placed.join(shared, "tkey"), "placed")
    wide = materialise(placed.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > WIDE).select("band"), "wide")
    narrow = placed.join(wide, "band", "left_anti")
    reach = 1.0 - NUM / DEN
    one = narrow.where("comp <> head").select("band", F.col("tkey").alias("a"), F.col(
        "far").alias("fa"), F.col("comp").alias("ca"), F.col("size").alias("sa"),
        F.col("sketch").alias("ka"), F.col("bands").alias("ba"))
    two = narrow.select("band", F.col("tkey").alias("b"), F.col("far").alias("fb"),
                        F.col("comp").alias("cb"), F.col("head").alias("hb"),
                        F.col("size").alias("sb"), F.col("sketch").alias("kb"),
                        F.col("bands").alias("bb"))
    rest = one.join(two, "band").where("ca <> cb").where(
        F.abs(F.col("fa") - F.col("fb")) <= reach + 1e-9) \
        .where((F.col("cb") == F.col("hb")) | (F.col("a") < F.col("b"))) \
        .where(_apart("ka", "kb") * (DEN + NUM) <= (F.col("sa") + F.col("sb")) * (DEN - NUM)) \
        .where(F.get(F.array_intersect("ba", "bb"), F.lit(0)) == F.col("band")) \
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    crowd = placed.join(wide, "band", "left_semi").select("tkey", "comp").distinct()
    rest = rest.unionByName(_prefix_pairs(crowd, bags)).distinct()
    rest = materialise(rest.join(star.select("a", "b"), ["a", "b"], "left_anti"), "rest")
    more = materialise(_similar(rest, bags).where(linked).select("a", "b"), "more")
    if more.isEmpty():
        return links, comps
    links = links.unionByName(more)
    return links, components(links)


def _unsettled(base: DataFrame, comps: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one class: band, tkey, far, comp."""
    placed = base.join(comps.withColumnRenamed("node", "tkey"), "tkey", "left") \
        .withColumn("comp", F.coalesce("comp", "tkey"))
    mixed = placed.groupBy("band").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")) \
        .where("_lo <> _hi").select("band")
    return placed.join(mixed, "band").select("band", "tkey", "far", "comp")


def _prefix_pairs(nodes: DataFrame, bags: DataFrame) -> DataFrame:
    """(a, b), a > b: pairs of ``nodes`` (tkey, comp) in different classes that share
    an element of both prefixes, which all pairs at the threshold do.

    An element that one text alone holds comes first in the order and matches
    nothing, so only the others are placed."""
    each = nodes.join(bags, "tkey").select("tkey", "comp", F.size("bag").alias("size"), "sketch",
                                           F.explode("bag").alias("el"))
    held = each.groupBy("el").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    # the shared elements of one text, at most its bag
    ranked = each.select("tkey", "size", "el").join(held, "el").groupBy("tkey", "size").agg(
        F.sort_array(F.collect_list(F.struct("n", "el"))).alias("els"))
    size = F.col("size")
    least = F.ceil(size * NUM / DEN).cast("int")  # elements that a partner must share
    length = F.greatest((size - least + 1) - (size - F.size("els")), F.lit(0))
    first = ranked.where(length > 0).select("tkey", F.transform(F.slice("els", F.lit(1), length),
                                                                lambda e: e["el"]).alias("prefix"))
    told = nodes.join(bags.select("tkey", F.size("bag").alias("size"), "sketch"), "tkey")
    entry = first.select("tkey", F.slice("prefix", 1, HEADS).alias("heads"), F.explode("prefix").alias("el")) \
        .join(told, "tkey")
    x = entry.select("el", F.col("tkey").alias("a"), F.col("comp").alias("ca"), F.col("size").alias("sa"),
                     F.col("sketch").alias("ka"), F.col("heads").alias("ha"))
    y = entry.select("el", F.col("tkey").alias("b"), F.col("comp").alias("cb"), F.col("size").alias("sb"),
                     F.col("sketch").alias("kb"), F.col("heads").alias("hb"))
    # both prefixes hold what their heads share, so the pair meets there and only there
    meets = F.coalesce(F.get(F.array_intersect("ha", "hb"), F.lit(0)) == F.col("el"), F.lit(True))
    return x.join(y, "el").where("a > b and ca <> cb") \
        .where((F.least("sa", "sb") * DEN >= F.greatest("sa", "sb") * NUM) & meets
               & (_apart("ka", "kb") * (DEN + NUM) <= (F.col("sa") + F.col("sb")) * (DEN - NUM))) \
        .select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, rep_id (least id of the equal texts), class_id (least id of the class)."""
    _, comps = near_duplicate_links(docs, id_col, text_col)
    return _classes(docs, comps, id_col, text_col).select("doc_id", "rep_id", "class_id")


def _classes(docs: DataFrame, comps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    narrow = _keyed(docs, id_col, text_col).select("doc_id", "tkey")
    reps = narrow.groupBy("tkey").agg(F.min("doc_id").alias("rep_id")) \
        .join(comps.withColumnRenamed("node", "tkey"), "tkey", "left") \
        .withColumn("comp", F.coalesce("comp", "tkey"))
    least = reps.groupBy("comp").agg(F.min(F.struct(
        F.col("rep_id").alias("class_id"), F.col("tkey").alias("class_key"))).alias("c"))
    per_text = materialise(reps.join(least, "comp").select("tkey", "rep_id", "c.*"), "classes")
    return narrow.join(per_text, "tkey")


def keep_one_per_class(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per class: the least id of the class's least text."""
    _, comps = near_duplicate_links(docs)
    chosen = _classes(docs, comps, "doc_id", "text") \
        .where((F.col("tkey") == F.col("class_key")) & F.col("doc_id").eqNullSafe(F.col("class_id"))) \
        .select(F.col("doc_id").alias("_id"), F.col("tkey").alias("_key")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("_r"), F.col("doc_id").alias("_d"),
                       F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("_k"))
    kept = rows.join(chosen, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key"))) \
        .dropDuplicates(["_d", "_k"])
    return kept.select("_r.*")
