"""Tables laid out for joins without exchange: bucketed external tables.

A table that is joined again and again on the same keys is written once with
those keys hashed into a fixed number of buckets; two tables with the same
buckets meet bucket by bucket, and neither is shuffled. The files lie below a
path of the caller's (a shared one), the table's name lives in the session.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twasprep.functions.genotype import clean_chromosome
from twasprep.operators import rsid as R

#: Parts a sample is cut into by its genes: a large sample spreads over buckets.
SAMPLE_PARTS = 16


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int,
                   partition_by: str | None = None, sort_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` hashed by ``keys`` into ``buckets`` (below one folder per value of
    ``partition_by``), each file sorted by ``sort_by``, and return the table."""
    name = f"bucketed_{uuid.uuid4().hex}"
    # one writer task per bucket: as many files, not tasks x buckets of them
    w = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys)
    if sort_by:
        w = w.sortBy(*sort_by)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def bucket_lookup(dbsnp: DataFrame, path: str, buckets: int, naming: str = "strict") -> DataFrame:
    """dbSNP's match keys with the id a lookup finds, bucketed by the whole key below
    one folder per chromosome: worked out once, joined by every cohort after that."""
    keys = R.rsid_lookup(dbsnp, naming).where(F.col("_resolved").isNotNull())
    return write_bucketed(keys.withColumn("folder", F.col("chrom_key")), path,
                          ["chrom_key", "pos", "ref", "match_alt"], buckets, "folder", ["pos", "ref"])


def bucket_snps(snps: DataFrame, path: str, buckets: int) -> DataFrame:
    """SNP annotation rows bucketed by the same key (rows without a position too)."""
    keyed = snps.select("*", clean_chromosome(F.col("chromosome").cast("string")).alias("_ck"),
                        F.col("pos").cast("long").alias("_pos"), F.col("ref_vcf").cast("string").alias("_ref"),
                        F.col("alt_vcf").cast("string").alias("_alt"))
    return write_bucketed(keyed, path, ["_ck", "_pos", "_ref", "_alt"], buckets, sort_by=["_pos", "_ref"])


def resolve_bucketed(snps: DataFrame, lookup: DataFrame, **kw) -> DataFrame:
    """``R.resolve_rsids`` over the two tables: only folders of the SNPs'
    chromosomes are read, and no row of either side is exchanged."""
    names = [r[0] for r in snps.select("_ck").where("_ck is not null").distinct().collect()]
    lookup = lookup.where(F.col("folder").cast("string").isin(names))
    on = ((snps["_ck"] == lookup["chrom_key"]) & (snps["_pos"] == lookup["pos"]) & (snps["_ref"] == lookup["ref"])
          & (snps["_alt"] == lookup["match_alt"]) & (snps["rsid"] == F.lit(R.UNRESOLVED_RSID)))
    cols = [c for c in snps.columns if c not in ("_ck", "_pos", "_ref", "_alt")]
    joined = snps.join(lookup, on, "left").select(*[snps[c] for c in cols], "_resolved")
    return R.fill_rsids(joined, cols, **kw)


def bucket_features(features: DataFrame, path: str, buckets: int) -> DataFrame:
    """Gene features by (sample, part of its genes): samples stay together bucket by
    bucket, and one large sample is spread over ``SAMPLE_PARTS`` of them."""
    part = F.pmod(F.xxhash64("gene_name"), F.lit(SAMPLE_PARTS)).cast("int")
    rows = features.select(F.col("sample_id").cast("string").alias("sample_id"), "gene_name",
                           F.col("ord").cast("long").alias("ord"), "features", part.alias("part"))
    return write_bucketed(rows, path, ["sample_id", "part"], buckets, sort_by=["sample_id", "part", "gene_name", "ord"])
