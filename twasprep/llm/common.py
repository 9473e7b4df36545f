"""Shared helpers: tables in the cluster's shared folder, text word pattern."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twasprep.session import ensure_checkpoint_dir

#: Characters that separate words (space, tab .. carriage return).
BLANKS = " \t\n\x0b\f\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage with files that every executor can read, so a lost
    executor never forces the work before this point to be repeated.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Shard count of hash-sharded steps: the session's shuffle width."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def words(text: Column) -> Column:
    """Words of a text as an array (empty for null or blank text)."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WORD_BREAK, -1))


def let(x: Column, f) -> Column:
    """f(x) with x computed once, also where the optimizer repeats the expression."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def lgamma(z: Column) -> Column:
    """ln Gamma(z) for z >= 1 (Stirling's series eight steps up, error < 1e-12)."""
    y = z + F.lit(8.0)
    series = ((y - 0.5) * F.log(y) - y + F.lit(0.9189385332046727)
              + 1.0 / (12.0 * y) - 1.0 / (360.0 * y * y * y) + 1.0 / (1260.0 * y * y * y * y * y))
    steps = z
    for i in range(1, 8):
        steps = steps * (z + float(i))
    return series - F.log(steps)


def binomial_cdf(k: Column, n: Column, p: float, terms: int = 4096) -> Column:
    """P(Binomial(n, p) <= k), never too small, for k < n * p (otherwise 1).

    Terms are added downwards from k; beyond ``terms`` of them the rest is
    replaced by its geometric upper bound, so the result stays an upper bound.
    """
    q = 1.0 - p
    kd, nd = k.cast("double"), n.cast("double")
    top = F.exp(lgamma(nd + 1.0) - lgamma(kd + 1.0) - lgamma(nd - kd + 1.0)
                + kd * F.log(F.lit(p)) + (nd - kd) * F.log(F.lit(q)))
    zero = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def step(acc, i):
        j = kd - i.cast("double")
        t = acc["t"] * j * q / ((nd - j + 1.0) * p)
        return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))

    last = F.least(kd, F.lit(float(terms)))
    idx = F.when(k > 0, F.sequence(F.lit(0), last.cast("int") - 1)).otherwise(
        F.array().cast("array<int>"))
    acc = F.aggregate(idx, zero, step)
    j = kd - last
    ratio = F.when(j > 0, j * q / ((nd - j + 1.0) * p)).otherwise(F.lit(0.0))
    total = acc["s"] + acc["t"] * ratio / (1.0 - ratio)
    return F.when(kd < nd * p, F.least(F.lit(1.0), top * total)).otherwise(F.lit(1.0))
