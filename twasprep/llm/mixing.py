"""Mixing sources to target weights by Poisson replication (native code).

A source with size share s and target share w is repeated at the mean rate
r = budget * w / s. Each document draws its number of copies by inverting the
Poisson(r) distribution at a uniform number hashed from (seed, doc_id), is
exploded by that number, and the copies are shuffled globally on a hashed key.

Without explicit weights the target of a source is size ** temperature
(temperature sampling), so every source of the input has a target.

Edge cases: a null source is a source of its own; null or empty texts have size
1, so no source has size zero; a source missing from explicit weights gets rate
0 (no copies); repeated rows draw alike; an empty table gives no rows. Input
columns come back as they are, whatever their names: the operator's own copy,
n_copies and mix_key take underscores in front until their names are free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twasprep.llm.common import lgamma, materialise, partitions

TEMPERATURE = 0.7
BUDGET = 1.0  # size of the mixture over the size of the input
SEED = 7
#: Standard deviations around the mean rate that the distribution array spans,
#: and terms on top: what lies outside is below the draw's resolution (2 ** -52).
SPAN, MORE = 12.0, 30.0


def _hash52(seed: int, *parts: Column) -> Column:
    """52 bits of md5 as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, 13),
                  16, 10).cast("long")


def source_rates(docs: DataFrame, weights: DataFrame | None = None, budget: float = BUDGET,
                 temperature: float = TEMPERATURE, source_col: str = "source",
                 text_col: str = "text") -> DataFrame:
    """source, size, rate, and the Poisson distribution function from ``base`` on.

    The array spans ``SPAN`` deviations around the rate, so it grows with the
    rate's root; its terms are rows of a running sum per source."""
    size = F.greatest(F.coalesce(F.length(F.col(text_col)), F.lit(0)), F.lit(1)).cast("long")
    sizes = docs.select(F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_src"),
                        size.alias("_n")) \
        .groupBy("_src").agg(F.sum("_n").alias("size"))
    if weights is None:
        target = sizes.withColumn("w", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        w = weights.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_src"),
                           F.col("weight").cast("double").alias("w")) \
            .groupBy("_src").agg(F.sum("w").alias("w"))
        target = sizes.join(w, "_src", "left").withColumn(
            "w", F.greatest(F.coalesce(F.col("w"), F.lit(0.0)), F.lit(0.0)))
    totals = target.agg(F.sum("size").alias("all_size"), F.sum("w").alias("all_w"))
    rated = target.join(F.broadcast(totals)).withColumn(
        "rate", F.when(F.col("all_w") > 0, F.lit(budget) * F.col("w") * F.col("all_size")
                       / (F.col("all_w") * F.col("size"))).otherwise(F.lit(0.0)))
    r, k = F.col("rate"), F.col("k")
    reach = SPAN * F.sqrt(r) + MORE
    rated = rated.withColumn("base", F.greatest(F.floor(r - reach), F.lit(0)).cast("long"))
    terms = rated.withColumn("k", F.explode(F.sequence("base", F.floor(r + reach).cast("long"))))
    mass = F.when(r > 0, F.exp(k * F.log(r) - r - lgamma(k.cast("double") + 1.0))).otherwise(
        F.when(k == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    running = F.sum(mass).over(Window.partitionBy("_src").orderBy("k").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    return terms.withColumn("cdf", running).groupBy("_src", "size", "rate", "base").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("k", "cdf"))), lambda x: x["cdf"]).alias("cdf"))


def poisson_counts(docs: DataFrame, rates: DataFrame, seed: int = SEED, id_col: str = "doc_id",
                   source_col: str = "source") -> DataFrame:
    """``_row`` (all columns of ``docs``), its id as text, and ``_n``: the least k
    whose distribution value exceeds the draw."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key.alias("_id"),
                         F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_src"))
    u = (_hash52(seed, F.col("_id")).cast("double") + 0.5) / F.lit(float(2 ** 52))
    n = F.col("base") + F.size(F.filter("cdf", lambda c: c <= F.col("_u")))
    return packed.withColumn("_u", u).join(rates.select("_src", "base", "cdf"), "_src").select(
        "_row", "_id", n.alias("_n"))


def poisson_replicas(docs: DataFrame, weights: DataFrame | None = None, budget: float = BUDGET,
                     temperature: float = TEMPERATURE, seed: int = SEED, id_col: str = "doc_id",
                     source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``_row`` once per copy with ``_copy`` (1..``_n``) and ``_key``, in a global
    pseudo-random order: dealt to partitions by the hashed key, sorted by it inside."""
    # written, so its size is known when the join is planned: a small table of
    # sources is broadcast and texts move once, in the shuffle below
    rates = materialise(source_rates(docs, weights, budget, temperature, source_col, text_col), "rates")
    counted = poisson_counts(docs, rates, seed, id_col, source_col).where("_n > 0")
    copies = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    key = _hash52(seed + 1, F.col("_id"), F.col("_copy").cast("string"))
    return copies.withColumn("_key", key).drop("_id") \
        .repartition(partitions(docs.sparkSession), "_key").sortWithinPartitions("_key")


def poisson_mix(docs: DataFrame, weights: DataFrame | None = None, **kw) -> DataFrame:
    """Input columns plus ``copy`` (1..n_copies), ``n_copies`` and ``mix_key``."""
    out = poisson_replicas(docs, weights, **kw)
    taken, own = {c.lower() for c in docs.columns}, []
    for name, value in (("copy", F.col("_copy").cast("int")), ("n_copies", F.col("_n").cast("int")),
                        ("mix_key", F.col("_key"))):
        while name.lower() in taken:
            name = f"_{name}"
        own.append(value.alias(name))
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns], *own)


def poisson_copies(docs: DataFrame, weights: DataFrame | None = None, **kw) -> DataFrame:
    """The copies with the columns of ``docs`` alone."""
    return poisson_replicas(docs, weights, **kw).select("_row.*")
