"""Shared steps of the exact vector searches: integer vectors, shards, blocks, pairs.

Rows are dealt into shards of bounded size and queries into blocks of bounded
size; a search visits (block, shard) pairs that a bound keeps alive, one pair of
packed rows in a task at a time. Nothing but bounded samples and counts per cell
(at most ``CELLS`` rows) reaches the driver.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twasprep.llm.common import materialise

#: Most cells a table is cut into; rows of a larger cell are dealt to parts by hash.
CELLS = 16384
#: Queries in a block.
BLOCK = 4096
#: Most tasks of one visit; beyond it a task takes several pairs, one after the other.
MOST_TASKS = 20000
#: Largest component of an integer vector; scores of up to 8,191 components fit a long.
LARGEST = 2 ** 25
#: Stands below every score.
NONE = -(2 ** 62)


def integer_vectors(rows: DataFrame, scale: int, vec_col: str, *keep: Column) -> DataFrame:
    """vec_id, q and ``keep``: floor(scale * x) of rows that hold an id and finite components.

    A vec_id names one row: where it repeats, the smallest (``keep``, q) stands.
    Components beyond ``LARGEST`` are an error, as their scores need not fit a long."""
    x = F.col(vec_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    q = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale))))
    q = F.when(F.exists(q, lambda v: (v > LARGEST) | (v < -LARGEST)), F.raise_error(F.lit(
        f"a vector component times {scale} lies beyond {LARGEST}"))).otherwise(q)
    out = rows.select(F.col("vec_id").cast("long").alias("vec_id"), *keep, q.alias("q"),
                      finite.alias("_ok")).where("vec_id is not null and _ok").drop("_ok")
    names = [c for c in out.columns if c != "vec_id"]
    one = out.groupBy("vec_id").agg(F.min(F.struct(*names)).alias("_row"))
    return one.select("vec_id", *[F.col(f"_row.{c}").alias(c) for c in names])


def sample(rows: DataFrame, n: int, size: int) -> DataFrame:
    """About ``size`` of ``n`` rows (all, if fewer), by id hash: only to place cells, never results."""
    return rows.where(F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(max(1, -(-n // size)))) == 0)


def dense(column, width: int | None = None) -> np.ndarray:
    """List column as an int64 matrix; missing components of short vectors are 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    width = int(sizes.max(initial=0)) if width is None else width
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def fit(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices at the wider one's width."""
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (a, b))


def exact_type(a: np.ndarray, b: np.ndarray):
    """float64 (fast product) where all sums are exact in it, else int64."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    return np.float64 if top < 2 ** 53 else np.int64


def pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob), allow_pickle=False) as z:
        return {k: z[k] for k in z.files}


def shard_of(placed: DataFrame, target: int) -> DataFrame:
    """``placed`` (vec_id, cell, ..) with its shard: a cell of over ``target`` rows in parts by hash."""
    counts = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / target).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("vec_id", F.lit("part")), F.col("_parts")).cast("long")
    return placed.join(F.broadcast(counts), "cell").withColumn(
        "shard", F.col("cell").cast("long") * 2 ** 32 + part).drop("_parts")


def block_of(queries: DataFrame, size: int = BLOCK) -> DataFrame:
    """``queries`` (query_id, cell, ..) with its block: about ``size`` queries of neighbouring cells."""
    counts = queries.groupBy("cell").agg(F.count(F.lit(1)).alias("_here"))
    counts = counts.withColumn("_before", F.sum("_here").over(Window.orderBy("cell")) - F.col("_here"))
    place = F.col("_before") + F.pmod(F.xxhash64("query_id", F.lit("block")), F.col("_here"))
    return queries.join(F.broadcast(counts), "cell").withColumn(
        "block", F.floor(place / size).cast("long")).drop("_here", "_before")


def all_pairs(blocks: DataFrame, shards: DataFrame, n_blocks: int) -> DataFrame:
    """Each block of the query set beside each shard: (block, shard, both sides' bounds)."""
    dealt = shards.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    return dealt.join(blocks, "block")


def visit(pairs: DataFrame, blocks: DataFrame, shards: DataFrame, search: Callable, schema: str) -> DataFrame:
    """``search(block arrays, shard arrays)`` -> record batch, for each (block, shard)."""
    pairs = materialise(pairs.select("block", "shard"), "vector-pairs")
    # a pair is seconds of work on little data: as many tasks as pairs, not as bytes suggest
    width = max(1, min(pairs.count(), MOST_TASKS))
    left = pairs.join(blocks.select("block", F.col("blob").alias("queries")), "block")
    right = pairs.join(shards.select("shard", F.col("blob").alias("rows")), "shard")

    def both(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return search(None, None)
        return search(unpack(a["queries"][0].as_py()), unpack(b["rows"][0].as_py()))

    # both sides stem from ``pairs``; new names keep their columns apart
    left, right = (side.select("block", "shard", c).toDF("block", "shard", c).repartition(width, "block", "shard")
                   for side, c in ((left, "queries"), (right, "rows")))
    return left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(both, schema)


def in_cells(rows: DataFrame, cell: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``rows`` with cell number ``cell(matrix)`` of each vector."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cells = cell(dense(b.column("q"))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells)], [*b.schema.names, "cell"])

    return rows.mapInArrow(place, ", ".join(f"{n} {t}" for n, t in [*rows.dtypes, ("cell", "int")]))
