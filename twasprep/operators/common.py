"""Skew-safe building blocks shared by the table operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key: the row with the smallest ``order_col``.

    ``min_by`` over a struct is a partial (map-side) aggregate, so a key that
    holds a large share of the rows is reduced on every mapper before the
    shuffle; no group is ever gathered in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(order_col)).alias("_first")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])


def last_wins(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key: the row with the largest ``order_col`` (dict update)."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(order_col)).alias("_last")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def first_n_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    n: int,
    rank_col: str = "rank",
    salt_buckets: int | None = None,
) -> DataFrame:
    """The first ``n`` rows of every key in ``order``, with their 1-based rank.

    Two rounds: first inside ``(key, salt)`` buckets, so a hot key is spread
    over many tasks and cut to ``n`` rows per bucket; then over the at most
    ``n * salt_buckets`` survivors per key. The default bucket count follows
    the shuffle width (``4 x spark.sql.shuffle.partitions``, at least 64) so a
    hot key reaches every reducer of the first round.
    """
    if salt_buckets is None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        salt_buckets = max(64, 4 * parts)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    stage1 = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= n)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return (stage1.withColumn(rank_col, F.row_number().over(w2))
            .where(F.col(rank_col) <= n)
            .drop("_salt", "_r1"))


def chromosome_list(chromosomes: str | Sequence[str] | None) -> list[str] | None:
    """``'all'``/None -> no filter; ``'1,2,X'`` or a list -> the names."""
    if chromosomes is None:
        return None
    if isinstance(chromosomes, str):
        if chromosomes.strip().lower() == "all":
            return None
        return [c.strip() for c in chromosomes.split(",") if c.strip()]
    return list(chromosomes)


def head_rows(df: DataFrame, n: int, order: Sequence[Column | str] | None = None) -> DataFrame:
    """First ``n`` rows (by ``order`` when given: a top-n, not a full sort)."""
    return (df.orderBy(*order) if order else df).limit(n)


def concat_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Concatenate tables by column name; columns missing from a table are
    NULL (multi-file inputs whose column sets differ)."""
    if not tables:
        raise ValueError("no tables")
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
