"""Genotype operators: VCF -> dosages -> allele counts -> MAF annotation.

Two layouts are supported. The *array* layout keeps one row per variant
with ``dosages array<tinyint>`` in sample-list order: extraction, allele
counting and matrix rendering are then row-local (no shuffle at all), which
is the layout to use at genome scale (tens of millions of variants times
thousands of samples). The *long* layout ``(varid, sample_id, dosage)`` is
the relational form; counting on it is a partial aggregate on ``varid``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twasprep.functions.genotype import (
    allele_counts_of,
    clean_chromosome,
    dosage_of_gt,
    dosage_of_token,
    folded_maf,
    gt_field_index,
    gt_of_sample_cell,
    natural_chromosome_order,
    reformat_varid,
    variant_id,
)
from twasprep.functions.vectors import place_by_position
from twasprep.operators.common import chromosome_list, last_wins
from twasprep.schemas import CONSTANT_R2, SNP_ANNOTATION_COLUMNS, UNRESOLVED_RSID
from twasprep.sources.tables import HeaderedRows
from twasprep.sources.vcf import VcfTable

def sample_values(samples: DataFrame | Sequence[str]) -> list[str]:
    """Sample ids in list order (a parameter of the job, like the names of a header)."""
    if isinstance(samples, DataFrame):
        return [r.sample_id for r in samples.orderBy("ord").select("sample_id").toLocalIterator()]
    return list(samples)


def sample_positions(headers: DataFrame, samples: DataFrame) -> DataFrame:
    """Per file: 1-based header positions of the listed samples, in list order.

    ``headers``: file_path, sample_names. A listed sample missing from a file
    gets a NULL position (its dosages are then missing). The result has one
    row per file and one int per listed sample.
    """
    cols = headers.select("file_path", F.posexplode("sample_names").alias("hpos", "sample_id"))
    files = headers.select("file_path")
    listed = samples.select("ord", "sample_id")
    found = cols.join(listed, "sample_id").select("file_path", "ord", (F.col("hpos") + 1).alias("p"))
    grouped = (found.groupBy("file_path")
               .agg(F.map_from_entries(F.collect_list(F.struct("ord", "p"))).alias("_m")))
    n_listed = len(sample_values(samples))
    empty = F.create_map().cast("map<int,int>")
    # both sides hold one row per file
    return files.join(F.broadcast(grouped), "file_path", "left").select(
        "file_path",
        F.transform(F.sequence(F.lit(0), F.lit(n_listed - 1)),
                    lambda o: F.element_at(F.coalesce(F.col("_m"), empty), o)).alias("positions"))


def extract_dosages(vcf: VcfTable, samples: DataFrame) -> DataFrame:
    """Array layout: ``varid, chrom, pos, ref, alt, dosages`` per VCF record.

    The GT sub-field of each listed sample's cell is mapped to a dosage with
    the exact phased rules; the per-file position list is broadcast (one row
    per file, one int per sample).
    """
    pos = sample_positions(vcf.headers, samples)
    recs = (vcf.records.join(F.broadcast(pos), "file_path")
            .withColumn("_gt", gt_field_index("format")))
    dos = F.transform("positions", lambda p: dosage_of_gt(
        gt_of_sample_cell(F.try_element_at("cells", p), F.col("_gt"))))
    return recs.select(
        variant_id("chrom", "pos", "ref", "alt").alias("varid"),
        "chrom", "pos", "ref", "alt",
        dos.alias("dosages"),
        "file_path", "line_no",
    )


def variant_annotation(vcf: VcfTable) -> DataFrame:
    """``varid, chrom, pos, ref, alt`` for every record, independent of samples."""
    return vcf.records.select(
        variant_id("chrom", "pos", "ref", "alt").alias("varid"), "chrom", "pos", "ref", "alt")


def dosages_long(arrays: DataFrame, samples: DataFrame) -> DataFrame:
    """Array layout -> long ``(varid, chrom, pos, sample_id, dosage)``."""
    exploded = arrays.select("varid", "chrom", "pos",
                             F.posexplode("dosages").alias("ord", "dosage"))
    return (exploded.join(samples.select("ord", "sample_id"), "ord")
            .select("varid", "chrom", "pos", "sample_id", "dosage"))


def dosage_from_gt(cells: DataFrame, gt_col: str = "gt") -> DataFrame:
    """Long layout: add ``dosage`` from a GT string column."""
    return cells.withColumn("dosage", dosage_of_gt(gt_col))


def dosage_matrix(dosages: DataFrame, samples: DataFrame | Sequence[str],
                  key: str = "varid") -> DataFrame:
    """Long -> wide: one column per sample in sample-list order (not sorted).

    Pivot values are passed explicitly (no extra job to discover them). The
    pivot is a single aggregation shuffle on the variant key.
    """
    values = sample_values(samples)
    return (dosages.groupBy(key).pivot("sample_id", values)
            .agg(F.max("dosage")))


def dosage_arrays(dosages: DataFrame, samples: DataFrame | Sequence[str],
                  key: str = "varid") -> DataFrame:
    """Long -> array layout: ``(varid, dosages)`` in sample-list order.

    One value per (variant, sample) is gathered per variant, so a row holds
    at most one entry per listed sample.
    """
    values = sample_values(samples)
    listed = dosages.sparkSession.createDataFrame(list(enumerate(values)),
                                                  "ord int, sample_id string")
    entry = F.struct("ord", F.col("dosage").alias("value"))
    per_var = (dosages.groupBy(key, "sample_id").agg(F.max("dosage").alias("dosage"))
               .join(listed, "sample_id", "left").groupBy(key)
               .agg(F.collect_list(F.when(F.col("ord").isNotNull(), entry)).alias("_e")))
    return per_var.select(key, place_by_position(F.col("_e"), len(values))
                          .cast("array<tinyint>").alias("dosages"))


def matrix_lines(arrays: DataFrame, sep: str = "\t", missing: str = ".",
                 keep: Sequence[str] = ()) -> DataFrame:
    """Array layout -> one text line per variant (row-local; matrix export).
    ``keep`` columns are carried next to ``value``."""
    cells = F.transform("dosages", lambda d: F.coalesce(d.cast("string"), F.lit(missing)))
    return arrays.select(*keep, F.concat_ws(sep, F.col("varid"), F.array_join(cells, sep))
                         .alias("value"))


def reformat_variant_ids(df: DataFrame, col: str = "varid", idempotent: bool = False) -> DataFrame:
    """Rewrite a variant-id column (leading ``chr`` dropped, build suffix added)."""
    return df.withColumn(col, reformat_varid(col, idempotent=idempotent))


def allele_counts(dosages: DataFrame, key: str = "varid") -> DataFrame:
    """Long layout: ``alt_count = sum(dosage)``, ``total_alleles = 2 x called``."""
    return dosages.groupBy(key).agg(
        F.coalesce(F.sum(F.col("dosage").cast("long")), F.lit(0).cast("long")).alias("alt_count"),
        (F.count("dosage") * 2).cast("long").alias("total_alleles"),
    )


def allele_counts_arrays(arrays: DataFrame) -> DataFrame:
    """Array layout: counts per row, no shuffle."""
    alt, total = allele_counts_of("dosages")
    return arrays.select("varid", alt.alias("alt_count"), total.alias("total_alleles"))


def matrix_allele_counts(matrix: HeaderedRows) -> DataFrame:
    """Dosage-matrix text rows -> counts; a repeated varID keeps its last row.

    Only the tokens ``0``, ``1``, ``2`` are calls; the header is ignored.
    """
    arrays = matrix.rows.select(
        "varid", "file_path", "line_no",
        F.transform("fields", lambda t: dosage_of_token(t)).alias("dosages"))
    alt, total = allele_counts_of("dosages")
    counts = arrays.select("varid", F.struct("file_path", "line_no").alias("_o"),
                           alt.alias("alt_count"), total.alias("total_alleles"))
    return last_wins(counts, ["varid"], "_o").drop("_o")


def maf_table(counts: DataFrame, digits: int | None = 5) -> DataFrame:
    """Counts -> ``MAF`` (folded at 0.5, half-even rounded, NULL without calls)."""
    return counts.withColumn("MAF", folded_maf("alt_count", "total_alleles", digits))


def annotate_maf(annotation: DataFrame, maf: DataFrame) -> DataFrame:
    """SNP annotation table driven by the variant annotation.

    ``annotation``: varid, chrom, pos, ref, alt. ``maf``: varid, MAF. Variants
    only in the genotypes are dropped; variants only in the annotation keep a
    NULL MAF. Both sides are large and keyed by varid: a sort-merge left
    join, split by AQE when one varid is hot.
    """
    m = (maf.select(F.col("varid").cast("string").alias("varid"), "MAF")
         .withColumn("_h", F.xxhash64("varid")))
    a = (annotation.withColumn("varid", F.col("varid").cast("string"))
         .withColumn("_h", F.xxhash64("varid")))
    # joining on the hash too keeps both inputs on plain join shuffles (the
    # MAF side is an aggregate on varid), the shape AQE's skew split handles
    j = a.join(m, ["varid", "_h"], "left")
    return j.select(
        clean_chromosome("chrom").alias("chromosome"),
        F.col("pos").cast("long").alias("pos"),
        F.col("varid").alias("varID"),
        F.col("ref").alias("ref_vcf"),
        F.col("alt").alias("alt_vcf"),
        F.lit(float(CONSTANT_R2)).alias("R2"),
        F.col("MAF").cast("double").alias("MAF"),
        F.lit(UNRESOLVED_RSID).alias("rsid"),
        F.lit(UNRESOLVED_RSID).alias("rsid_dbSNP150"),
    ).select(*SNP_ANNOTATION_COLUMNS)


def filter_chromosomes(df: DataFrame, chromosomes, col: str = "chromosome") -> DataFrame:
    """Keep the listed chromosomes (``'all'`` keeps everything). On a table
    partitioned by the column this prunes partitions at the scan."""
    names = chromosome_list(chromosomes)
    return df if names is None else df.where(F.col(col).isin(names))


def maf_annotation_of(cells: DataFrame, annotation: DataFrame, chromosomes="all") -> DataFrame:
    """GT calls (``varid, chrom, sample_id, gt``) and annotation -> SNP annotation
    of the listed chromosomes, filtered on both sides before anything is
    aggregated or shuffled."""
    names = chromosome_list(chromosomes)
    if names is not None:
        listed = clean_chromosome("chrom").isin(names)
        cells, annotation = cells.where(listed), annotation.where(listed)
    return annotate_maf(annotation, maf_table(allele_counts(dosage_from_gt(cells))))


def chromosome_order(df: DataFrame, col: str = "chromosome") -> DataFrame:
    """Distinct chromosome names with their natural rank (1, 2, ..., 10, X)."""
    # The ranked set is the distinct chromosome names (a few dozen rows).
    names = df.select(col).distinct()
    w = Window.orderBy(*natural_chromosome_order(col))
    return names.withColumn("chrom_rank", F.row_number().over(w))


# Re-exported column helpers used next to the operators.
__all__ = [
    "allele_counts", "allele_counts_arrays", "annotate_maf", "chromosome_order",
    "clean_chromosome", "dosage_from_gt", "dosage_matrix", "dosages_long", "extract_dosages",
    "filter_chromosomes", "maf_table", "matrix_allele_counts", "matrix_lines",
    "reformat_variant_ids", "reformat_varid", "sample_positions", "sample_values",
    "snp_annotation_from_genotypes", "variant_annotation", "dosage_arrays",
    "snp_annotation_single_pass", "snp_annotation_from_vcf_arrays",
]


def snp_annotation_from_genotypes(genotypes, annotation: DataFrame, chromosomes="all"
                                  ) -> DataFrame:
    """SNP annotation with MAF from any genotype layout.

    ``genotypes``: dosage-matrix text rows (``HeaderedRows``), the array
    layout (``varid, dosages``) or the long layout (``varid, sample_id,
    dosage``); ``chromosomes``: ``'all'`` or a comma list / list of names.
    """
    if isinstance(genotypes, HeaderedRows):
        counts = matrix_allele_counts(genotypes)
    elif "dosages" in genotypes.columns:
        counts = allele_counts_arrays(genotypes)
    else:
        counts = allele_counts(genotypes)
    return filter_chromosomes(annotate_maf(annotation, maf_table(counts)), chromosomes)


def snp_annotation_single_pass(arrays: DataFrame) -> DataFrame:
    """SNP annotation straight from the array layout, without any join.

    When the variant annotation and the dosages come from the same VCF
    records, each row already holds both: allele counts, MAF and the
    annotation columns are computed row by row (a map-only job, no
    shuffle). A variant id that occurs in several records would get the MAF
    of each own record here, while the two-file path gives every such row
    the MAF of the last one; ``snp_annotation_from_vcf_arrays`` checks for
    that case.
    """
    alt, total = allele_counts_of("dosages")
    return arrays.select(
        clean_chromosome("chrom").alias("chromosome"),
        F.col("pos").cast("long").alias("pos"),
        F.col("varid").alias("varID"),
        F.col("ref").alias("ref_vcf"),
        F.col("alt").alias("alt_vcf"),
        F.lit(float(CONSTANT_R2)).alias("R2"),
        folded_maf(alt, total).alias("MAF"),
        F.lit(UNRESOLVED_RSID).alias("rsid"),
        F.lit(UNRESOLVED_RSID).alias("rsid_dbSNP150"),
    )


def snp_annotation_from_vcf_arrays(arrays: DataFrame) -> DataFrame:
    """Single pass when variant ids are unique, else the last-wins join path.

    The uniqueness check is one aggregation over the id column only
    (partial aggregation; it returns at most one row)."""
    dup = (arrays.groupBy("varid").agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > 1).limit(1).count())
    if dup == 0:
        return snp_annotation_single_pass(arrays)
    ordered = arrays.withColumn("_o", F.struct("file_path", "line_no"))
    alt, total = allele_counts_of("dosages")
    counts = last_wins(ordered.select("varid", "_o", alt.alias("alt_count"),
                                      total.alias("total_alleles")), ["varid"], "_o").drop("_o")
    ann = arrays.select("varid", "chrom", "pos", "ref", "alt")
    return annotate_maf(ann, maf_table(counts))
