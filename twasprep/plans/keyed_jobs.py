"""File jobs by key (input file, chromosome, sample), each key committed on its own.

Outputs are partitioned by the key, and a key that is run again replaces its own
partitions only, so a run can be ended anywhere and repeated (``restart``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twasprep.operators import features as FT
from twasprep.operators import genotype as G
from twasprep.operators import rsid as R
from twasprep.operators.common import chromosome_list
from twasprep.plans import workflows as WF
from twasprep.plans.restart import run_keys
from twasprep.sinks import writers as W
from twasprep.sources import tables as S
from twasprep.sources.positions import read_with_source
from twasprep.sources.text import list_files, read_sample_list, sample_from_path
from twasprep.sources.vcf import read_vcf

#: Partition column that names the input file of a row.
SRC = "src"


def file_key(path: Column) -> Column:
    """An input file's key: its name without the last extensions."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1),
                            r"(\.(vcf|txt|tsv|csv|gz|bgz|bz2))+$", "")


def input_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(key, path) of the files of a job that reads whole files; a folder's files
    that begin with ``_`` or ``.`` are none. Same-named files share a key."""
    files = list_files(spark, path, recursive=True).where(~F.col("file_name").rlike("^[._]"))
    return files.select(file_key(F.col("path")).alias("key"), "path")


def _paths(batch: DataFrame) -> list[str]:
    """File paths of a batch: what a reader is opened with (one per file)."""
    return sorted(r.path for r in batch.select("path").distinct().toLocalIterator())


def _counts(written: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    keys = batch.select(F.col("key").alias(key)).distinct()
    return written.join(keys, key, "left_semi").groupBy(F.col(key).cast("string").alias("key")).agg(
        F.count(F.lit(1)).alias("rows"))


def extract_by_file(spark: SparkSession, vcf_path: str, samples_path: str, out_dir: str,
                    attempts_path: str, reformat: bool = True) -> DataFrame:
    """VCF files -> dosage matrices and variant annotation, file by file."""
    samples = read_sample_list(spark, samples_path)

    def work(batch: DataFrame) -> DataFrame:
        vcf = read_vcf(spark, _paths(batch))
        src = file_key(F.col("file_path")).alias(SRC)
        arrays = G.extract_dosages(vcf, samples).select("*", src)
        ann = vcf.records.select(G.variant_id("chrom", "pos", "ref", "alt").alias("varid"), "chrom", "pos", "ref",
                                 "alt", src)
        arrays = arrays.repartition(spark.sparkContext.defaultParallelism, "varid")
        if reformat:
            arrays, ann = G.reformat_variant_ids(arrays), G.reformat_variant_ids(ann)
        W.write_dosage_matrix(arrays, samples, f"{out_dir}/genotype", mode="overwrite",
                              partition_by=[SRC, "chrom"], by_partition=True)
        W.write_variant_annotation(ann, f"{out_dir}/variant_annotation", mode="overwrite", partition_by=SRC)
        lines = spark.read.text(f"{out_dir}/variant_annotation").withColumn(SRC, F.col(SRC).cast("string"))
        return _counts(lines, batch, SRC)

    return run_keys(input_files(spark, vcf_path), "extract", attempts_path, work)


def maf_by_chromosome(spark: SparkSession, genotype_path: str, annotation_path: str, out_dir: str,
                      attempts_path: str, chromosomes="all") -> DataFrame:
    """Dosage matrices + annotation -> SNP annotation, chromosome by chromosome.

    The keys are the annotation's chromosomes (of the list, where one is given);
    a chromosome's files are told by their names where those name one."""
    listed = chromosome_list(chromosomes)
    ann = S.read_variant_annotation(spark, annotation_path)
    keys = ann.select(G.clean_chromosome("chrom").alias("key")).distinct()
    if listed is not None:
        plain = [c.strip().removeprefix("chr") for c in listed]
        keys = keys.where(F.col("key").isin(plain))

    def work(batch: DataFrame) -> DataFrame:
        # a chromosome list: as many names as a genome has chromosomes
        names = [r.key for r in batch.select("key").distinct().collect()]
        snps = WF.maf_annotation(spark, genotype_path, annotation_path, names)
        W.write_snp_annotation(snps, out_dir, mode="overwrite", partition_by="chromosome", by_partition=True)
        lines = spark.read.text(out_dir).where(~F.col("value").startswith("chromosome\t")).select(
            F.col("chromosome_part").cast("string").alias("chromosome_part"))
        return _counts(lines, batch, "chromosome_part")

    return run_keys(keys, "maf", attempts_path, work)


def rsid_by_file(spark: SparkSession, snp_path: str, dbsnp_path: str, out_dir: str, attempts_path: str,
                 naming: str = "strict", dbsnp_format: str = "vcf") -> tuple[DataFrame, DataFrame]:
    """SNP annotation files + dbSNP -> annotation with rsIDs, file by file; returns
    the attempts' summary and the resolution statistics per chromosome.

    Of a landed dbSNP only the folders of the files' chromosomes are read."""
    staged = f"{out_dir}/_resolved"

    def work(batch: DataFrame) -> DataFrame:
        snps = S.read_snp_annotation(spark, _paths(batch), with_file=True).withColumn(
            SRC, file_key(F.col("file_path")))
        if dbsnp_format == "parquet":
            dbsnp = WF.of_chromosomes_in(WF.read_landed_dbsnp(spark, dbsnp_path), snps)
        else:
            dbsnp = S.read_dbsnp_vcf(spark, dbsnp_path)
        resolved = R.resolve_rsids(snps, dbsnp, naming=naming, with_flag=True, lookup_chromosome="file")
        (resolved.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SRC)
         .parquet(staged))
        written = read_staged()
        here = written.join(batch.select(F.col("key").alias(SRC)).distinct(), SRC, "left_semi")
        W.write_snp_annotation(here.drop("rsid_found"), f"{out_dir}/with_rsids", missing_maf="", mode="overwrite",
                               partition_by="chromosome", by_partition=True, src=SRC)
        return _counts(written, batch, SRC)

    def read_staged() -> DataFrame:
        return spark.read.parquet(staged).withColumn(SRC, F.col(SRC).cast("string"))

    summary = run_keys(input_files(spark, snp_path), "rsid", attempts_path, work)
    if not WF._exists(spark, staged):
        return summary, spark.createDataFrame([], "chromosome string, total long, found long, pct double")
    return summary, R.rsid_stats(read_staged())


def gene_features_by_sample(spark: SparkSession, tensors_path: str, windows_path: str, out_dir: str,
                            attempts_path: str, chunk_rows: int | None = None) -> DataFrame:
    """Region tensors -> region features -> gene mean features, sample by sample.

    Samples are told by ``sample_id=<id>`` folders, and a batch opens its samples'
    files alone; where the files hold the id, all are read and rows selected."""
    files = list_files(spark, tensors_path, recursive=True).where(F.col("file_name").endswith(".parquet"))
    keyed = files.where(F.col("path").contains("/sample_id=")).select(
        F.url_decode(F.replace(sample_from_path("path"), F.lit("+"), F.lit("%2B"))).alias("key"), "path")
    foldered = not keyed.isEmpty()
    everything = None if foldered else WF._text_ids(spark, tensors_path)
    keys = keyed if foldered else everything.select(F.col("sample_id").alias("key")).distinct()
    windows = S.read_gene_windows(spark, windows_path)

    def work(batch: DataFrame) -> DataFrame:
        if foldered:
            reader = spark.read.option("basePath", tensors_path)
            tensors = read_with_source(spark, _paths(batch), reader=reader)
            tensors = tensors.withColumn("sample_id", F.url_decode(F.regexp_replace(F.regexp_extract(
                "src_file", "/sample_id=([^/]+)/", 1), r"\+", "%2B")))
        else:
            tensors = read_with_source(spark, tensors_path, everything.schema)
            tensors = tensors.join(batch.select(F.col("key").alias("sample_id")), "sample_id", "left_semi")
        feats = WF.write_regions(
            tensors, out_dir, chunk_rows is not None,
            lambda df: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic"),
            batch.select(F.col("key").alias("sample_id")).distinct())
        means = (FT.first_chunk_means(windows, feats, chunk_rows) if chunk_rows
                 else FT.gene_region_means(windows, feats))
        means = means.withColumn("ord", F.monotonically_increasing_id())
        W.write_gene_features(means, f"{out_dir}/gene_features", mode="overwrite", by_partition=True)
        return _counts(spark.read.schema(means.schema).parquet(f"{out_dir}/gene_features"), batch, "sample_id")

    return run_keys(keys, "gene-features", attempts_path, work)
