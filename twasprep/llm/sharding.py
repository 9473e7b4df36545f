"""Reproducible shuffle into shards by a Feistel permutation (native code).

Rows get global numbers 0..N-1 (a hash bucket's offset plus the rank inside the
bucket); a keyed Feistel network over Z_a x Z_b with a * b >= N, walked until it
lands below N, permutes them. ``shard = p % n_shards`` and ``slot = p //
n_shards``: counts differ by at most one, slots have no gaps, and both can be
computed from a row number alone (:func:`permute`). Only ids, sizes and
checksums are shuffled, never texts.

Edge cases: null text has size 16 and checksum 0; a null id is a value of its
own; rows equal in id, size and checksum are interchangeable, so the result is
the same set of rows in any run; texts of any length are sized whole; an empty
table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

N_SHARDS = 40
ROUNDS = 4
SEED = 20240611
#: Hash buckets of the numbering: bounds the offset table, not the data.
BUCKETS = 4096
#: Longest walk. At most a - 1 of the a * b points lie outside 0..N-1, so for
#: a <= 64 no walk is longer; beyond that a walk of w steps has chance < b ** -w,
#: and one that has not ended is an error.
WALK = 64


def _md5_int(*parts) -> Column:
    """32 bits of md5 over the parts joined by ':' as a long (any SQL engine has it)."""
    text = F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def domain(n: Column) -> tuple[Column, Column]:
    """Sides (a, b) of the smallest near-square grid with a * b >= n."""
    root = F.floor(F.sqrt(n.cast("double"))).cast("long")
    a = F.greatest(F.when(root * root >= n, root).otherwise(root + 1), F.lit(1))
    return a, F.greatest(F.floor((n + a - 1) / a).cast("long"), F.lit(1))


def _feistel(x: Column, a: Column, b: Column, seed: int, rounds: int) -> Column:
    """One pass of the network: alternately add a keyed hash of one half to the other."""
    # each round keeps a struct so that no half is expanded twice in the plan
    state = F.struct((x % a).alias("l"), F.floor(x / a).cast("long").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        left = F.pmod(s["l"] + _md5_int(seed, i.cast("string"), s["r"].cast("string")), a)
        right = F.pmod(s["r"] + _md5_int(seed, i.cast("string"), s["l"].cast("string")), b)
        return F.when(i % 2 == 0, F.struct(left.alias("l"), s["r"].alias("r"))).otherwise(
            F.struct(s["l"].alias("l"), right.alias("r")))

    out = F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), state, turn)
    return out["r"] * a + out["l"]


def permute(x: Column, n: Column, a: Column, b: Column, seed: int = SEED,
            rounds: int = ROUNDS) -> Column:
    """Image of row number ``x`` under the permutation of 0..n-1."""
    start = _feistel(x, a, b, seed, rounds)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), start, lambda p, _: F.when(p < n, p).otherwise(
            _feistel(p, a, b, seed, rounds)),
        lambda p: F.when(p < n, p).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long")))


def shard(docs: DataFrame, n_shards: int = N_SHARDS, seed: int = SEED, id_col: str = "doc_id",
          text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    # many rows with one id part by their texts
    rows = rows.withColumn("bucket", F.pmod(_md5_int(
        "row", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text_crc32").cast("string"),
        F.col("size").cast("string")), F.lit(buckets)).cast("int"))
    # at most ``buckets`` rows: the running sum below is small at any input size
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_in"))
    running = Window.orderBy("bucket")
    offsets = counts.select(
        "bucket", (F.sum("n_in").over(running) - F.col("n_in")).alias("offset"),
        F.sum("n_in").over(Window.partitionBy(F.lit(0))).alias("n"))
    a, b = domain(F.col("n"))
    offsets = offsets.withColumn("a", a).withColumn("b", b)
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(
        F.col("doc_id").asc_nulls_first(), "text_crc32", "size"))
    numbered = rows.withColumn("rank", rank).join(F.broadcast(offsets), "bucket").withColumn(
        "row_number", F.col("offset") + F.col("rank") - 1)
    p = permute(F.col("row_number"), F.col("n"), F.col("a"), F.col("b"), seed)
    return numbered.withColumn("p", p).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("p") % n_shards).cast("int").alias("shard"),
        F.floor(F.col("p") / n_shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_number")
