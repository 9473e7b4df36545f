"""Variant -> dbSNP identifier resolution as set joins.

A per-variant index seek becomes one equi-join of the variant table with a
pre-aggregated dbSNP key table on ``(chromosome, pos, ref, alt)``. Both
sides are hash-partitioned on the same four keys, so the aggregate's
exchange is reused by the join (one exchange per side), and the join is
1 : 0..1 by construction.

Chromosome naming: the lookup asks the bare name first (``1``) and the
``chr`` name (``chr1``) only when the bare region query returns no record
at all. A region query returns every record *overlapping* the position, so
a longer bare-named record starting a few bases earlier also blocks the
fallback. ``naming="strict"`` (default) reproduces exactly that;
``naming="normalized"`` treats both namings as one chromosome and takes the
first match preferring bare names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twasprep.functions.genotype import clean_chromosome
from twasprep.operators.intervals import overlaps
from twasprep.schemas import UNRESOLVED_RSID

_KEYS = ["chrom_key", "pos", "ref", "match_alt"]


def normalize_dbsnp(dbsnp: DataFrame) -> DataFrame:
    """``chrom_key`` (name without one ``chr`` prefix) and ``naming`` 0/1."""
    # canonical key types (a chromosome read back from a partition directory
    # may come back as an integer)
    chrom = F.col("chrom").cast("string")
    chr_named = chrom.startswith("chr")
    return dbsnp.select(
        F.when(chr_named, F.substring(chrom, 4, 1 << 20)).otherwise(chrom).alias("chrom_key"),
        F.when(chr_named, F.lit(1)).otherwise(F.lit(0)).alias("naming"),
        F.col("pos").cast("long").alias("pos"), F.col("rsid").cast("string").alias("rsid"),
        F.col("ref").cast("string").alias("ref"), F.col("alt").cast("string").alias("alt_raw"),
        "ord",
    )


def dbsnp_match_keys(dbsnp: DataFrame) -> DataFrame:
    """First rsid per match key and naming: one row per (chrom, pos, ref, alt).

    A record matches a query allele equal to its whole ALT text or to any
    element of its comma list; ``min_by(rsid, ord)`` keeps the first record
    in file order (a partial aggregate: hot keys are combined map-side).
    """
    n = normalize_dbsnp(dbsnp)
    alts = F.array_distinct(F.array_append(F.split("alt_raw", ","), F.col("alt_raw")))
    cand = n.select("chrom_key", "naming", "pos", "ref", "rsid", "ord",
                    F.explode(alts).alias("match_alt"))
    return cand.groupBy(*_KEYS).agg(
        F.min_by(F.when(F.col("naming") == 0, F.col("rsid")),
                 F.when(F.col("naming") == 0, F.col("ord"))).alias("rsid_bare"),
        F.min_by(F.when(F.col("naming") == 1, F.col("rsid")),
                 F.when(F.col("naming") == 1, F.col("ord"))).alias("rsid_chr"),
    )


def record_spans(dbsnp: DataFrame, naming: int | None = None) -> DataFrame:
    """(chrom_key, naming, rsid, ord, first, last): the positions a record covers,
    ``pos`` to ``pos + len(ref) - 1`` (the allele texts stay behind)."""
    n = normalize_dbsnp(dbsnp)
    if naming is not None:
        n = n.where(F.col("naming") == naming)
    span = F.greatest(F.length("ref"), F.lit(1)).cast("long")
    return n.where(F.col("pos").isNotNull() & span.isNotNull()).select(
        "chrom_key", "naming", "rsid", "ord", F.col("pos").alias("first"),
        (F.col("pos") + span - 1).alias("last"))


def overlapping_records(snps: DataFrame, dbsnp: DataFrame) -> DataFrame:
    """Per variant row: how many records overlap its position, the first of them
    in file order, and the span of the longest (0 without any)."""
    v = snps.select("varID", clean_chromosome(F.col("chromosome").cast("string")).alias("chrom_key"),
                    F.col("pos").cast("long").alias("_pos"))
    at = v.where(F.col("_pos").isNotNull()).select("chrom_key", "_pos").distinct()
    hits = overlaps(at, record_spans(dbsnp), ["chrom_key"], "_pos", "first", "last").groupBy(
        "chrom_key", "_pos").agg(
            F.count(F.lit(1)).alias("hits"), F.min_by("rsid", "ord").alias("first_rsid"),
            F.max(F.col("last") - F.col("first") + 1).alias("longest"))
    zero = F.lit(0).cast("long")
    return v.join(hits, ["chrom_key", "_pos"], "left").select(
        "varID", F.coalesce("hits", zero).alias("hits"), "first_rsid",
        F.coalesce("longest", zero).alias("longest"))


def rsid_lookup(dbsnp: DataFrame, naming: str = "strict") -> DataFrame:
    """The id a lookup finds per match key, settled on the dbSNP side.

    A bare-named match always wins (it proves that the bare region query has a
    record). Only keys matched under the ``chr`` name alone are in doubt: in
    strict mode they count unless some bare-named record overlaps the
    position: an overlap join of the ``chr``-named starts with the bare records'
    spans, so a long deletion is one or two rows, and a file with one naming
    checks nothing.
    """
    keys = dbsnp_match_keys(dbsnp)
    if naming == "normalized":
        return keys.select(*_KEYS, F.coalesce("rsid_bare", "rsid_chr").alias("_resolved"))
    n = normalize_dbsnp(dbsnp)
    starts = (n.where((F.col("naming") == 1) & F.col("pos").isNotNull())
              .select("chrom_key", F.col("pos").alias("_bq")).distinct())
    bare = (overlaps(starts, record_spans(dbsnp, naming=0), ["chrom_key"], "_bq", "first", "last")
            .select(F.col("chrom_key").alias("_bk"), "_bq").distinct()
            .withColumn("_bare_hit", F.lit(True)))
    in_doubt = F.col("rsid_bare").isNull() & F.col("rsid_chr").isNotNull()
    j = keys.join(bare, (F.col("chrom_key") == F.col("_bk")) & (F.col("pos") == F.col("_bq"))
                  & in_doubt, "left")
    return j.select(*_KEYS, F.when(F.col("rsid_bare").isNotNull(), F.col("rsid_bare"))
                    .when(F.col("_bare_hit").isNull(), F.col("rsid_chr")).alias("_resolved"))


def _prepared(snps: DataFrame) -> DataFrame:
    if "rsid" not in snps.columns:
        snps = snps.withColumn("rsid", F.lit(UNRESOLVED_RSID))
    return snps


def resolve_rsids(
    snps: DataFrame,
    dbsnp: DataFrame,
    naming: str = "strict",
    legacy_fill: bool = False,
    with_flag: bool = False,
    lookup_chromosome: str = "row",
) -> DataFrame:
    """Fill ``rsid`` of rows whose rsid is exactly ``.`` from dbSNP.

    * rows with another rsid, or a NULL rsid, are left alone;
    * rows without a position cannot match (NULL never equals) but are kept;
    * ``rsid_dbSNP150`` (when present) receives the resolved id as well;
    * ``legacy_fill=True``: a set ``rsid_dbSNP150`` (not ``.``) is copied into
      ``rsid`` first and that column is not updated.

    Same rows out as in; ``with_flag`` adds ``rsid_found`` (newly resolved).

    ``lookup_chromosome``: ``"row"`` looks every row up under its own
    chromosome; ``"file"`` uses the chromosome of the first row of the row's
    file for the whole file, as a per-file lookup does (needs ``file_path``
    and ``file_order`` columns, see ``read_snp_annotation(with_file=True)``;
    one row per file is gathered and broadcast back).
    """
    if naming not in ("strict", "normalized"):
        raise ValueError("naming must be 'strict' or 'normalized'")
    snps = _prepared(snps)
    cols = [c for c in snps.columns if c not in ("file_path", "file_order")]
    chrom_col = F.col("chromosome")
    if lookup_chromosome == "file":
        first = snps.groupBy("file_path").agg(
            F.min_by(F.col("chromosome"), F.col("file_order")).alias("_file_chrom"))
        snps = snps.join(F.broadcast(first), "file_path")
        chrom_col = F.col("_file_chrom")
    elif lookup_chromosome != "row":
        raise ValueError("lookup_chromosome must be 'row' or 'file'")
    is_open = F.coalesce(F.col("rsid") == F.lit(UNRESOLVED_RSID), F.lit(False))
    keyed = snps.where(is_open).select(
        "*",
        clean_chromosome(chrom_col.cast("string")).alias("_ck"),
        F.col("pos").cast("long").alias("_pos"),
        F.col("ref_vcf").cast("string").alias("_ref"),
        F.col("alt_vcf").cast("string").alias("_alt"),
    )
    lookup = rsid_lookup(dbsnp, naming).withColumn("_h", F.xxhash64(*_KEYS))
    keyed = keyed.withColumn("_h", F.xxhash64("_ck", "_pos", "_ref", "_alt"))
    # ``_h`` is a function of the four keys. Joining on it as well makes the
    # planner shuffle both inputs for the join itself instead of reusing the
    # aggregate's partitioning, which is the shape AQE can split when one
    # key holds a large share of the variants.
    j = keyed.join(
        lookup,
        (keyed["_h"] == lookup["_h"]) & (keyed["_ck"] == lookup["chrom_key"])
        & (keyed["_pos"] == lookup["pos"])
        & (keyed["_ref"] == lookup["ref"]) & (keyed["_alt"] == lookup["match_alt"]),
        "left",
    ).select(*[keyed[c] for c in cols], "_resolved")
    # rows that already have an id (or NULL) never enter the join
    closed = snps.where(~is_open).select(*cols, F.lit(None).cast("string").alias("_resolved"))
    j = j.unionByName(closed)
    return fill_rsids(j, cols, legacy_fill, with_flag)


def fill_rsids(joined: DataFrame, cols: list[str], legacy_fill: bool = False,
               with_flag: bool = False) -> DataFrame:
    """``cols`` of rows that carry the id found for them (``_resolved``), filled in
    as ``resolve_rsids`` says."""
    has150 = "rsid_dbSNP150" in cols
    resolved = F.col("_resolved")
    open_row = F.col("rsid") == F.lit(UNRESOLVED_RSID)
    if legacy_fill and has150:
        legacy = F.when(F.col("rsid_dbSNP150").isNotNull()
                        & (F.col("rsid_dbSNP150") != F.lit(UNRESOLVED_RSID)), F.col("rsid_dbSNP150"))
        new_rsid = F.coalesce(legacy, resolved)
        found = open_row & new_rsid.isNotNull()
        out_cols = {"rsid": F.when(found, new_rsid).otherwise(F.col("rsid"))}
    else:
        found = open_row & resolved.isNotNull()
        out_cols = {"rsid": F.when(found, resolved).otherwise(F.col("rsid"))}
        if has150:
            out_cols["rsid_dbSNP150"] = F.when(found, resolved).otherwise(F.col("rsid_dbSNP150"))
    select = [out_cols[c].alias(c) if c in out_cols else F.col(c) for c in cols]
    if with_flag:
        select.append(F.coalesce(found, F.lit(False)).alias("rsid_found"))
    return joined.select(*select)


def rsid_stats(resolved: DataFrame) -> DataFrame:
    """Per chromosome: total rows, newly resolved rows, percent resolved.

    ``resolved`` must carry ``rsid_found`` (``resolve_rsids(with_flag=True)``).
    """
    return resolved.groupBy("chromosome").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("rsid_found")).cast("long").alias("found"),
    ).withColumn("pct", F.round(F.col("found").cast("double") * F.lit(100.0)
                                / F.col("total").cast("double"), 6))


def rsid_naming_report(snps: DataFrame, dbsnp: DataFrame, n: int = 3,
                       sample_size: int | None = None, order_col: str | None = None
                       ) -> DataFrame:
    """Per variant row: region hits under the bare and the ``chr`` name, and the
    first ``n`` record ids of the naming a lookup would use.

    Hits are records overlapping the position; the first ``n`` come from a
    salted two-round top-n, so a position with very many records is never
    ranked in one task. ``sample_size`` restricts the report to the first
    variants (by ``order_col``, e.g. the line order), as a quick look.
    """
    if sample_size is not None:
        snps = (snps.orderBy(order_col) if order_col else snps).limit(sample_size)
    v = (snps.select("varID", clean_chromosome(F.col("chromosome").cast("string")).alias("_ck"),
                     F.col("pos").cast("long").alias("_pos"))
         .where(F.col("_pos").isNotNull()))
    # one lookup per position: variants that share an id or a position do not
    # multiply each other's hits
    at = v.select("_ck", "_pos").distinct()
    hits = overlaps(at, record_spans(dbsnp).withColumnRenamed("chrom_key", "_ck"), ["_ck"],
                    "_pos", "first", "last").select("_ck", "_pos", "naming", "rsid", "ord")
    parts = int(snps.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    salted = hits.withColumn("_salt", F.pmod(F.xxhash64("ord"), F.lit(max(64, 4 * parts))))
    bucket = Window.partitionBy("_ck", "_pos", "naming", "_salt")
    # counts and first records travel together: at most n rows per bucket, the
    # first of which carries the bucket's count
    kept = (salted.withColumn("_n", F.count(F.lit(1)).over(bucket))
            .withColumn("_r", F.row_number().over(bucket.orderBy("ord")))
            .where(F.col("_r") <= n))

    def count_of(k: int) -> Column:
        one = F.when((F.col("naming") == k) & (F.col("_r") == 1), F.col("_n"))
        return F.coalesce(F.sum(one), F.lit(0)).cast("long")

    def first_of(k: int) -> Column:
        ids = F.collect_list(F.when(F.col("naming") == k, F.struct("ord", "rsid")))
        return F.array_join(F.transform(F.slice(F.array_sort(ids), 1, n), lambda s: s["rsid"]), ",")

    found = kept.groupBy("_ck", "_pos").agg(
        count_of(0).alias("bare_hits"), count_of(1).alias("chr_hits"),
        first_of(0).alias("_bare"), first_of(1).alias("_chr"))
    bare_used, chr_used = F.col("bare_hits") > 0, F.col("chr_hits") > 0
    return v.join(found, ["_ck", "_pos"], "left").select(
        "varID",
        F.coalesce("bare_hits", F.lit(0).cast("long")).alias("bare_hits"),
        F.coalesce("chr_hits", F.lit(0).cast("long")).alias("chr_hits"),
        F.when(bare_used, F.lit("bare")).when(chr_used, F.lit("chr")).alias("used_naming"),
        F.when(bare_used, F.col("_bare")).when(chr_used, F.col("_chr")).alias("first_hits"))
