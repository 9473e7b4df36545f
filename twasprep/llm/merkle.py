"""Merkle manifest of a table: concatenated level strings, hashed by substrings.

Every document is a leaf; per source the leaves ascend by id and every 16
consecutive nodes become their hash until one is left, the subroot; subroots,
ordered by source, become the root the same way.

Leaves are numbered inside their source without gathering a source: one range
sort over (source, id, leaf), then each sorted partition's count per source is
added up over the partitions (a table of partitions x sources). An aligned block
of ``ARITY ** DEPTH`` = 4096 leaves keeps each of its levels as one hex string:
fixed-width substrings of 16 digests hash to the next level's string, and what
flanks a digest inside its substring are its siblings. Block roots are the nodes
of the next round (``N / 4096`` rows), so rounds recurse until a source has one
block. Proofs are put together top down: a block's path above it is joined to
the block once, never to each of its leaves, and only digests of the proofs
leave the task.

Edge cases: a null field is ``-``; a null id sorts first and is never tampered
with; leaves with one id are ordered by their hash, so rows that are equal in
all five fields are interchangeable; a lone leaf is its source's subroot, a lone
source's subroot the root (its proof is then the hash of the empty string); an
empty table gives no rows; texts of any length are hashed whole; other columns
are never read, so their names cannot clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twasprep.llm.common import materialise

ARITY = 16
#: Levels hashed inside one block; a block has ARITY ** DEPTH leaves.
DEPTH = 3
BLOCK = ARITY ** DEPTH
#: Characters of one digest and of one run of siblings.
DIGEST = 64
RUN = ARITY * DIGEST
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One tampered document in this many (by checksum of the id).
TAMPER = 5


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    """Digest of a row: each value ``-`` or its byte count, ``:`` and itself."""
    return F.sha2(F.concat(*[_field(v) for v in values]), 256)


def _group_key(source: Column) -> Column:
    """A non-null key that sorts as the source does bytewise, null first."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), source))


def number(nodes: DataFrame, order: list[str], tag: str) -> DataFrame:
    """``nodes`` with ``idx`` (from 0 inside ``grp``, by ``order``) and ``n`` (of the group)."""
    rows = nodes.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in ["grp", *order, "_tie"]]
    placed = materialise(rows.orderBy(*keys).drop("_tie").withColumn(
        "_at", F.monotonically_increasing_id()), tag)
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    counts = placed.groupBy("grp", "_part").agg(F.count(F.lit(1)).alias("here"),
                                                F.min("_at").alias("first"))
    before = Window.partitionBy("grp").orderBy("_part")
    shifts = counts.select("grp", "_part",
                           (F.sum("here").over(before) - F.col("here") - F.col("first")).alias("_shift"),
                           F.sum("here").over(Window.partitionBy("grp")).alias("n"))
    return placed.join(shifts, ["grp", "_part"]).withColumn(
        "idx", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _parents(level: Column) -> Column:
    """The next level's string: every run of digests hashed, the last run as it is."""
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / RUN).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(
        F.substring(level, i * RUN + 1, F.lit(RUN)), 256)), "")


def _blocks(nodes: DataFrame, payload: list[str], tag: str) -> DataFrame:
    """grp, n, block, items (by position), level strings l0.., root of each aligned block.

    A group of several blocks has all DEPTH levels of every block; a group of
    one block stops where one digest is left (later levels are null)."""
    item = F.struct((F.col("idx") % BLOCK).cast("int").alias("pos"), "hash", *payload)
    out = nodes.groupBy("grp", "n", F.floor(F.col("idx") / BLOCK).cast("long").alias("block")).agg(
        F.sort_array(F.collect_list(item)).alias("items"))
    out = out.withColumn("l0", F.array_join(F.transform("items", lambda x: x["hash"]), ""))
    for k in range(DEPTH):
        here = F.col(f"l{k}")
        out = out.withColumn(f"l{k + 1}", F.when((F.col("n") > BLOCK) | (F.length(here) > DIGEST),
                                                 _parents(here)))
    top = F.coalesce(*[F.col(f"l{k}") for k in range(DEPTH, -1, -1)])
    return materialise(out.withColumn("root", top), tag)


def climb(nodes: DataFrame, payload: list[str], tag: str) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks from the leaves up, and (grp, root) of every group.

    ``nodes``: grp, n, idx, hash and the payload columns."""
    rounds, done = [], []
    while True:
        blocks = _blocks(nodes, payload if not rounds else [], f"{tag}-{len(rounds)}")
        rounds.append(blocks)
        done.append(blocks.where(F.col("n") <= BLOCK).select("grp", "root"))
        nodes = blocks.where(F.col("n") > BLOCK).select(
            "grp", F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("block").alias("idx"),
            F.col("root").alias("hash"))
        if nodes.isEmpty():
            roots = done[0]
            for other in done[1:]:
                roots = roots.unionByName(other)
            return rounds, roots


def _members(blocks: DataFrame, payload: list[str]) -> DataFrame:
    """grp, idx, hash, payload, the block's columns above, and ``segs``: the
    siblings (left, right) of each level from the node to its group's root."""
    levels = [k for k in range(DEPTH)]

    def run(r: Column) -> Column:
        parts = []
        for k in levels:
            place = F.floor(r / ARITY ** k).cast("int") * RUN + 1
            parts.append(F.when(F.col(f"l{k + 1}").isNotNull(), F.substring(F.col(f"l{k}"), place, F.lit(RUN)))
                         .alias(f"r{k}"))
        return F.struct(r.alias("r"), F.slice("items", r * ARITY + 1, ARITY).alias("own"), *parts)

    runs = F.sequence(F.lit(0), F.floor((F.size("items") - 1) / ARITY).cast("int"))
    a = blocks.select("grp", "block", "upper", *[c for c in ("subroot", "root_of_all") if c in blocks.columns],
                      F.explode(F.transform(runs, run)).alias("run"))
    b = a.withColumn("node", F.explode("run.own"))

    def seg(k: int) -> Column:
        at = F.col("node.pos") if k == 0 else F.floor(F.col("run.r") / ARITY ** (k - 1)).cast("int")
        text, p = F.col(f"run.r{k}"), at % ARITY
        return F.when(text.isNotNull(), F.struct(
            F.substring(text, F.lit(1), p * DIGEST).alias("left"),
            F.substring(text, p * DIGEST + DIGEST + 1, F.lit(RUN)).alias("right")))

    own = F.filter(F.array(*[seg(k) for k in levels]), lambda s: s.isNotNull())
    return b.select("grp", (F.col("block") * BLOCK + F.col("node.pos")).alias("idx"),
                    F.col("node.hash").alias("hash"), *[F.col(f"node.{c}").alias(c) for c in payload],
                    *[c for c in ("subroot", "root_of_all") if c in a.columns],
                    F.concat(own, F.col("upper")).alias("segs"))


def paths(rounds: list[DataFrame], above: DataFrame, payload: list[str]) -> DataFrame:
    """Every node of the first round with its siblings up to the top.

    ``above``: per group the segments over its root (``upper``) and columns to
    hand down; joined to blocks, not to nodes."""
    hand = [c for c in above.columns if c != "grp"]
    upper = None  # grp, block, hand..
    for t in range(len(rounds) - 1, -1, -1):
        blocks = rounds[t]
        one = blocks.where(F.col("n") <= BLOCK).join(above, "grp")
        if upper is not None:
            one = one.unionByName(blocks.where(F.col("n") > BLOCK).join(upper, ["grp", "block"]))
        nodes = _members(one, payload if t == 0 else [])
        if t:
            upper = nodes.select("grp", F.col("idx").alias("block"), F.col("segs").alias("upper"),
                                 *[c for c in hand if c != "upper"])
    return nodes


def fold(leaf: Column, segs: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(segs, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def tampered_text(doc_id: Column, text: Column) -> Column:
    """A-Z lower-cased where 5 divides the checksum of the decimal id."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % TAMPER == 0
    return F.when(hit, F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(text)


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    doc_id, source, lang, n_chars, text = (F.col(c) for c in FIELDS)
    leaves = docs.select(
        _group_key(source).alias("grp"), doc_id.alias("doc_id"),
        leaf_hash(doc_id, source, lang, n_chars, text).alias("hash"),
        leaf_hash(doc_id, source, lang, n_chars, tampered_text(doc_id, text)).alias("tampered"))
    payload = ["doc_id", "tampered"]
    # texts are read and hashed once: the range sort below samples and reads the digests
    leaves = number(materialise(leaves, "merkle-hashed"), ["doc_id", "hash"], "merkle-leaves")
    rounds, subroots = climb(leaves, payload, "merkle-blocks")
    none = F.array().cast("array<struct<left:string,right:string>>")
    tops = number(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("of"),
                                  F.col("root").alias("hash")), ["of"], "merkle-subroots")
    over, root = climb(tops, ["of"], "merkle-top")
    start = root.select("grp", none.alias("upper"), F.col("root").alias("root_of_all"))
    above = paths(over, start, ["of"]).select(
        F.col("of").alias("grp"), F.col("hash").alias("subroot"), "root_of_all", F.col("segs").alias("upper"))
    out = paths(rounds, above, payload)
    siblings = F.array_join(F.transform("segs", lambda s: F.concat(s["left"], s["right"])), "")
    return out.select(
        "doc_id", F.col("hash").alias("leaf"), "subroot", F.col("root_of_all").alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"), fold(F.col("tampered"), F.col("segs")).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
