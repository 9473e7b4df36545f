"""Reconciliation of the four trainer inputs by their keys, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twasprep.schemas import EXPORT_KEY

#: Per kind of key: the table that describes it and the table that uses it.
SIDES = {"variant": ("snp_annotation", "genotype"), "gene": ("gene_annotation", "expression")}


def _key_of(df: DataFrame, *names: str):
    """The first of ``names`` that the table has, as text."""
    for n in names:
        if n in df.columns:
            return F.col(n).cast("string")
    raise ValueError(f"none of {names} among {df.columns}")


def bundle_report(gene_annotation: DataFrame, snp_annotation: DataFrame, genotype: DataFrame,
                  expression: DataFrame) -> DataFrame:
    """``(item, value)``: rows, keys and repeated keys of every table, and the keys
    that only one table of a pair has, in both directions.

    All four key columns are stacked and counted per key once (a partial
    aggregate, so a hot key is no group), then counted over. A null key is a key
    of its own; an absent table's items are 0.
    """
    stacked = None
    for kind, described, df, key in (
            ("variant", True, snp_annotation, _key_of(snp_annotation, "varID", "varid")),
            ("variant", False, genotype, _key_of(genotype, "varID", "varid")),
            ("gene", True, gene_annotation, _key_of(gene_annotation, "ensembl_id", "gene_name")),
            ("gene", False, expression, _key_of(expression, EXPORT_KEY, "gene_name"))):
        one = F.lit(1).cast("long")
        part = df.select(F.lit(kind).alias("kind"), key.alias("key"),
                         (one if described else one * 0).alias("a"), (one * 0 if described else one).alias("b"))
        stacked = part if stacked is None else stacked.unionByName(part)
    per_key = stacked.groupBy("kind", "key").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    a, b = F.col("a"), F.col("b")
    counts = per_key.groupBy("kind").agg(
        F.sum("a").alias("rows_a"), F.sum("b").alias("rows_b"), F.count_if(a > 0).alias("keys_a"),
        F.count_if(b > 0).alias("keys_b"), F.count_if(a > 1).alias("repeated_a"),
        F.count_if(b > 1).alias("repeated_b"), F.count_if((a > 0) & (b == 0)).alias("only_a"),
        F.count_if((a == 0) & (b > 0)).alias("only_b"))
    items = []
    for kind, (described, used) in SIDES.items():
        for side, table, other in (("a", described, used), ("b", used, described)):
            for name, column in ((f"{table}_rows", "rows"), (f"{table}_keys", "keys"),
                                 (f"{table}_repeated_keys", "repeated"), (f"{table}_keys_not_in_{other}", "only")):
                value = F.sum(F.when(F.col("kind") == kind, F.col(f"{column}_{side}")))
                items.append(F.struct(F.lit(name).alias("item"),
                                      F.coalesce(value, F.lit(0)).cast("long").alias("value")))
    # two rows at most meet here
    return counts.agg(F.array(*items).alias("items")).select(F.explode("items").alias("i")).select("i.*")


def inconsistencies(report: DataFrame) -> DataFrame:
    """The items of a report that should be 0 and are not."""
    return report.where((F.col("item").contains("_not_in_") | F.col("item").endswith("_repeated_keys"))
                        & (F.col("value") > 0))
