"""End-to-end jobs over files: each stage reads its inputs, runs the
operators and commits its output. Stages hand over through written tables,
which also cuts lineage (a lost executor recomputes from the last written
stage, not from the raw inputs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twasprep.operators import expression as X
from twasprep.operators import features as FT
from twasprep.operators import genotype as G
from twasprep.operators import manifest as MF
from twasprep.operators import predict as P
from twasprep.operators import rsid as R
from twasprep.operators import validate as VA
from twasprep.operators.common import chromosome_list
from twasprep.sinks import writers as W
from twasprep.sources import tables as S
from twasprep.sources.positions import add_positions, read_with_source
from twasprep.schemas import EXPORT_KEY
from twasprep.sources.text import list_files, read_lines, read_sample_list, sample_from_path
from twasprep.sources.vcf import read_vcf


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a dataset path has files (a listing, no data read)."""
    from pyspark.errors import AnalysisException

    try:
        return list_files(spark, path, recursive=True).limit(1).count() > 0
    except AnalysisException:
        return False


def land_dbsnp(spark: SparkSession, vcf_path: str, out_path: str, mode: str = "errorifexists",
               partitions: int | None = None, split_gzip: bool = False) -> None:
    """dbSNP VCF -> Parquet partitioned by chromosome, sorted by position.

    ``repartitionByRange`` on (chromosome, position) samples the keys, so
    large and small chromosomes are cut into balanced tasks; sorted files
    give row-group min/max statistics on ``pos``. ``ord`` (file order) is kept
    as a (block, row) pair so "first record wins" survives the landing.
    """
    db = S.read_dbsnp_vcf(spark, vcf_path, split_gzip=split_gzip)
    n = partitions or spark.sparkContext.defaultParallelism
    (db.repartitionByRange(n, "chrom", "pos").sortWithinPartitions("chrom", "pos")
     .write.mode(mode).partitionBy("chrom").parquet(out_path))


def read_landed_dbsnp(spark: SparkSession, path: str) -> DataFrame:
    # the partition column comes back typed by inference ("1" -> int)
    return spark.read.parquet(path).select(F.col("chrom").cast("string").alias("chrom"),
                                           "pos", "rsid", "ref", "alt", "ord")


def of_chromosomes_in(dbsnp: DataFrame, snps: DataFrame) -> DataFrame:
    """The dbSNP rows of the chromosomes that ``snps`` name (bare or ``chr``-named):
    a filter on the landed table's folders, so the others are not read. The names
    are as few as a genome's chromosomes and contigs."""
    names = [r.c for r in snps.select(G.clean_chromosome(F.col("chromosome").cast("string")).alias("c"))
             .where("c is not null").distinct().collect()]
    return dbsnp.where(F.col("chrom").isin([*names, *[f"chr{c}" for c in names]]))


def land_genotypes(spark: SparkSession, vcf_path: str, samples_path: str, out_path: str,
                   mode: str = "errorifexists", split_gzip: bool = False) -> None:
    """VCF -> Parquet in the array layout ``(varid, chrom, pos, ref, alt,
    dosages)`` partitioned by chromosome (parse once, reuse many times)."""
    vcf = read_vcf(spark, vcf_path, split_gzip=split_gzip)
    arrays = G.extract_dosages(vcf, read_sample_list(spark, samples_path))
    (arrays.drop("file_path", "line_no").write.mode(mode).partitionBy("chrom")
     .parquet(out_path))


def snp_annotation_from_vcf(spark: SparkSession, vcf_path: str, samples_path: str,
                            out_dir: str, reformat: bool = True,
                            mode: str = "errorifexists") -> None:
    """VCF -> landed dosage arrays -> SNP annotation with MAF.

    The VCF text is parsed once into array-layout Parquet
    (``<out_dir>/genotype_arrays``, reused by later stages); the annotation
    is then a map-only pass over that table. The repeated-id check reads
    only the ``varid`` column of the Parquet table.
    """
    arrays_path = f"{out_dir.rstrip('/')}/genotype_arrays"
    vcf = read_vcf(spark, vcf_path)
    arrays = G.extract_dosages(vcf, read_sample_list(spark, samples_path))
    if reformat:
        arrays = G.reformat_variant_ids(arrays)
    arrays.write.mode(mode).partitionBy("chrom").parquet(arrays_path)
    landed = spark.read.parquet(arrays_path)
    landed = landed.withColumn("chrom", F.col("chrom").cast("string"))
    W.write_snp_annotation(G.snp_annotation_from_vcf_arrays(landed),
                           f"{out_dir.rstrip('/')}/snp_annotation", mode=mode,
                           partition_by="chromosome")


def extract_genotypes(spark: SparkSession, vcf_path: str, samples_path: str, out_dir: str,
                      reformat: bool = True, mode: str = "errorifexists") -> None:
    """VCF -> dosage matrix (per chromosome) + variant annotation.

    The parse of a bgzip file is one task per file; variants are then spread
    by ``repartition`` on the variant id before the wide per-row work.
    """
    vcf = read_vcf(spark, vcf_path)
    samples = read_sample_list(spark, samples_path)
    arrays = G.extract_dosages(vcf, samples)
    arrays = arrays.repartition(spark.sparkContext.defaultParallelism, "varid")
    ann = G.variant_annotation(vcf)
    if reformat:
        arrays = G.reformat_variant_ids(arrays)
        ann = G.reformat_variant_ids(ann)
    W.write_dosage_matrix(arrays, samples, f"{out_dir}/genotype", mode=mode)
    W.write_variant_annotation(ann, f"{out_dir}/variant_annotation", mode=mode)


def _of_chromosomes(chromosomes):
    """Files to open: those of the listed chromosomes (``chr<X>_...`` or a
    ``chrom=chr<X>`` folder) and those whose path names none."""
    names = chromosome_list(chromosomes)
    if names is None:
        return None
    plain = {n.strip().removeprefix("chr").lstrip("0") for n in names}
    wanted = sorted(plain | ({"M", "MT"} if plain & {"M", "MT"} else set()))

    def keep(path):
        named = F.coalesce(F.nullif(F.regexp_extract(path, "/chrom=(?:chr)?([^/]+)/[^/]*$", 1), F.lit("")),
                           F.regexp_extract(path, "/chr([^/_.]+)[_.][^/]*$", 1))
        # only a chromosome's name, written as in the list, lets a file go unread
        known = F.rlike(named, F.lit("^(?:[1-9]|1[0-9]|2[0-2]|X|Y|M|MT)$"))
        return ~known | named.isin(wanted)

    return keep


def maf_annotation(spark: SparkSession, genotype_path: str, annotation_path: str,
                   chromosomes="all") -> DataFrame:
    """Dosage-matrix text + headerless annotation text -> SNP annotation."""
    keep = _of_chromosomes(chromosomes)
    matrix = S.read_dosage_matrix(spark, genotype_path, keep_path=keep)
    ann = S.read_variant_annotation(spark, annotation_path, keep_path=keep)
    maf = G.maf_table(G.matrix_allele_counts(matrix))
    snps = G.annotate_maf(ann, maf)
    return G.filter_chromosomes(snps, chromosomes)


def maf_annotation_job(spark: SparkSession, genotype_path: str, annotation_path: str,
                       out_dir: str, chromosomes="all", mode: str = "errorifexists") -> None:
    snps = maf_annotation(spark, genotype_path, annotation_path, chromosomes)
    W.write_snp_annotation(snps, out_dir, mode=mode, partition_by="chromosome")


def rsid_job(spark: SparkSession, snp_path: str, dbsnp_path: str, out_dir: str,
             naming: str = "strict", mode: str = "errorifexists",
             dbsnp_format: str = "vcf") -> DataFrame:
    """SNP annotation + dbSNP VCF -> annotation with rsIDs; returns the
    per-chromosome resolution statistics."""
    snps = S.read_snp_annotation(spark, snp_path, with_file=True)
    dbsnp = (of_chromosomes_in(read_landed_dbsnp(spark, dbsnp_path), snps) if dbsnp_format == "parquet"
             else S.read_dbsnp_vcf(spark, dbsnp_path))
    # one lookup chromosome per input file (its first row), as per-file runs do
    resolved = R.resolve_rsids(snps, dbsnp, naming=naming, with_flag=True,
                               lookup_chromosome="file")
    resolved.write.mode(mode).parquet(f"{out_dir}/_resolved")
    written = spark.read.parquet(f"{out_dir}/_resolved")
    W.write_snp_annotation(written.drop("rsid_found"), f"{out_dir}/with_rsids", missing_maf="",
                           mode=mode, partition_by="chromosome")
    return R.rsid_stats(written)


def write_regions(tensors: DataFrame, out_dir: str, positions: bool, writer,
                  samples: DataFrame | None = None) -> DataFrame:
    """Region features of ``tensors`` (with their source) in ``out_dir``, read back.

    With ``positions`` they carry ``ord``, counted over the rows that were kept: the
    vectors are staged once beside their source, and only counts are added up. Of
    folders that hold more than ``samples`` (sample_id), those alone are read back."""
    spark = tensors.sparkSession
    regions = FT.region_bin_means(tensors)

    def written(df: DataFrame, path: str) -> DataFrame:
        writer(df).partitionBy("sample_id").parquet(path)
        # with the schema given, ids such as 007 stay text in the partition folders
        back = spark.read.schema(df.schema).parquet(path)
        return back if samples is None else back.join(samples, "sample_id", "left_semi")

    if positions:
        regions = add_positions(written(regions, f"{out_dir}/_staged_regions"))
    return written(regions.drop("src_file", "src_row"), f"{out_dir}/region_features")


def gene_features_job(spark: SparkSession, tensors_path: str, windows_path: str, out_dir: str,
                      chunk_rows: int | None = None, mode: str = "errorifexists") -> None:
    """Region tensors (Parquet) -> region features -> gene mean features.

    Chunks are cut by a row's position in its sample: rejected regions have none,
    a sample may lie in several files (taken in name order), and the positions
    are worked out only for chunked means."""
    feats = write_regions(read_with_source(spark, tensors_path), out_dir, chunk_rows is not None,
                          lambda df: df.write.mode(mode))
    windows = S.read_gene_windows(spark, windows_path)
    means = (FT.first_chunk_means(windows, feats, chunk_rows) if chunk_rows
             else FT.gene_region_means(windows, feats))
    means = means.withColumn("ord", F.monotonically_increasing_id())
    W.write_gene_features(means, f"{out_dir}/gene_features", mode=mode)


def _text_ids(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose partition folder ``sample_id`` is read as text."""
    schema = spark.read.parquet(path).schema
    for field in schema.fields:
        if field.name == "sample_id":
            field.dataType = T.StringType()
    return spark.read.schema(schema).parquet(path)


def prediction_job(spark: SparkSession, gene_features_path: str, scorer, out_dir: str,
                   manifest_path: str | None = None, features_format: str = "parquet") -> None:
    """Gene features -> z-scores -> long predictions, for samples that have no
    successful manifest entry yet; appends the new manifest entries.
    ``features_format="csv"`` reads wide feature CSVs (plain or gzip)."""
    feats = (S.read_feature_csv(spark, gene_features_path) if features_format == "csv"
             else _text_ids(spark, gene_features_path))
    if manifest_path is not None and _exists(spark, manifest_path):
        manifest = spark.read.parquet(manifest_path)
        todo = MF.pending(feats.select(F.col("sample_id").alias("key")).distinct(),
                          manifest, "predict")
        feats = feats.join(todo, feats["sample_id"] == todo["key"], "left_semi")
    preds = P.predict_expression(P.zscore_features(feats), scorer)
    # dynamic partition overwrite: a sample re-run after a crash between the
    # prediction commit and the manifest append replaces its own partition
    out = f"{out_dir}/predictions"
    (preds.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("sample_id").parquet(out))
    # per sample, from the keys: no row of any model may be missing
    genes = P.distinct_genes(feats)
    written = _text_ids(spark, out) if _exists(spark, out) else preds.limit(0)
    P.require_conserved(P.row_conservation(genes, written.join(
        genes.select("sample_id"), "sample_id", "left_semi"), len(scorer.cell_types)))
    if manifest_path is not None:
        done = (feats.groupBy("sample_id").agg(F.count(F.lit(1)).alias("rows"))
                .select(F.lit("predict").alias("stage"), F.col("sample_id").alias("key"),
                        F.lit("success").alias("status"), F.col("rows").cast("long")))
        done.write.mode("append").parquet(manifest_path)


def expression_job(spark: SparkSession, predictions_csv: str, samples: list[str],
                   gene_annotation_path: str, out_dir: str, mode: str = "errorifexists"
                   ) -> DataFrame:
    """Per-sample prediction CSVs -> cell-type matrices -> PredictDB export;
    returns the unmapped gene report."""
    files = S.read_predictions_csv(spark, predictions_csv)
    long = X.predictions_long_from_files(files)
    _write_matrices(long, samples, f"{out_dir}/cell_type_matrices", mode)
    written = spark.read.option("header", "true").csv(f"{out_dir}/cell_type_matrices")
    anno = S.read_gene_annotation(spark, gene_annotation_path)
    W.write_predictdb_expression(X.to_predictdb_expression(written, anno),
                                 f"{out_dir}/predictdb", mode=mode)
    return X.unmapped_genes(written, anno)


def _write_matrices(long: DataFrame, samples: list[str], path: str, mode: str) -> None:
    """One gene x sample CSV directory per cell type, built as text lines
    (constant plan width for any number of samples; last row of a repeated
    gene wins; missing cells empty)."""
    header = ",".join(["gene_name", *sorted(samples)])
    lines = X.cell_type_matrix_lines(long, samples, order_col="ord")
    W.write_lines_with_header(lines, header, path, partition_by="cell_type", mode=mode)


def rename_job(spark: SparkSession, predictions_csv: str, out_dir: str,
               mode: str = "errorifexists") -> None:
    """Per-sample prediction CSVs with legacy column names -> renamed CSVs.

    Only header names change; rows keep their text, order of cells, repeated
    genes and other columns. The sample id becomes a partition directory
    (``sample_id=<id>``)."""
    files = X.rename_headers(S.read_predictions_csv(spark, predictions_csv))
    lines = X.csv_lines(files)
    W.write_lines_by_header(lines, out_dir, "sample_id", mode=mode)


def split_job(spark: SparkSession, predictions_csv: str, out_dir: str,
              samples: list[str] | None = None, mode: str = "errorifexists",
              input_format: str = "csv") -> None:
    """Per-sample prediction CSVs -> one gene x sample matrix per cell type
    (``input_format="parquet"``: the long predictions of ``prediction_job``).

    ``samples`` defaults to the discovered files' sample ids (a listing of
    file names, bounded by the number of files)."""
    if input_format == "parquet":
        long = _text_ids(spark, predictions_csv).withColumn("ord", F.lit(0))
        if samples is None:
            samples = [r.sample_id for r in long.select("sample_id").distinct().collect()]
        _write_matrices(long, samples, out_dir, mode)
        return
    files = S.read_predictions_csv(spark, predictions_csv)
    if samples is None:
        # every discovered file is a sample column, also one that fails to
        # parse; the listing does not open the files
        listed = list_files(spark, predictions_csv, recursive=True).where(
            F.col("file_name").endswith(".csv") | F.col("file_name").endswith(".csv.gz"))
        samples = [r.s for r in listed.select(sample_from_path("path", S.CSV_SUFFIX).alias("s"))
                   .distinct().collect()]
    long = X.predictions_long_from_files(files)
    _write_matrices(long, samples, out_dir, mode)


def transform_job(spark: SparkSession, matrices_csv: str, gene_annotation_path: str,
                  out_dir: str, mode: str = "errorifexists",
                  manifest_path: str | None = None) -> DataFrame:
    """Cell-type matrix CSVs (header discovery) -> PredictDB expression
    (tab, gzip, NAME + samples) per cell type; returns the unmapped report.

    Every file keeps its own sample header. With ``manifest_path`` cell types
    already done are skipped, and a file without a header is recorded as failed
    while the others go on."""
    m = S.read_cell_type_matrix(spark, matrices_csv)
    failed = m.headers.where(F.col("names").isNull()).select("cell_type").distinct()
    if manifest_path is not None and _exists(spark, manifest_path):
        # cell types that an earlier run finished are skipped
        todo = MF.pending(m.headers.select(F.col("cell_type").alias("key")).distinct(),
                          spark.read.parquet(manifest_path), "transform").select(
                              F.col("key").alias("cell_type"))
        m = S.HeaderedRows(m.rows, m.headers.join(todo, "cell_type", "left_semi"))
        failed = failed.join(todo, "cell_type", "left_semi")
        mode = "append"
    # cells stay text (as the original conversion keeps them); one array per row
    wide = m.joined().select("cell_type", F.element_at("fields", 1).alias("gene_name"),
                             F.slice("fields", 2, F.size("fields") - 1).alias("cells"),
                             F.slice("names", 2, F.size("names") - 1).alias("samples"))
    anno = S.read_gene_annotation(spark, gene_annotation_path)
    mapped = X.to_predictdb_expression(wide, anno)
    lines = mapped.select(
        "cell_type", F.concat_ws("\t", F.lit("NAME"), F.array_join("samples", "\t")).alias("header"),
        F.concat_ws("\t", "NAME", F.array_join("cells", "\t")).alias("value"))
    W.write_lines_by_header(lines, out_dir, "cell_type", compression="gzip", mode=mode)
    if manifest_path is not None:
        done = wide.groupBy("cell_type").agg(F.count(F.lit(1)).cast("long").alias("rows")).select(
            F.lit("transform").alias("stage"), F.col("cell_type").alias("key"),
            F.lit("success").alias("status"), "rows")
        bad = failed.select(F.lit("transform").alias("stage"), F.col("cell_type").alias("key"),
                            F.lit("failed").alias("status"), F.lit(0).cast("long").alias("rows"))
        done.unionByName(bad).write.mode("append").parquet(manifest_path)
    return X.unmapped_summary(X.unmapped_genes(wide.select("gene_name"), anno))


def validate_job(spark: SparkSession, matrices_csv: str, sample_rows: int | None = None
                 ) -> DataFrame:
    """Shape and V1-V5 checks of every cell-type matrix file."""
    return VA.validate_files(S.read_cell_type_matrix(spark, matrices_csv), sample_rows)


def bundle_job(spark: SparkSession, gene_annotation_path: str, snp_path: str, genotype_path: str,
               expression_path: str, out_dir: str, mode: str = "errorifexists") -> DataFrame:
    """The four trainer inputs as the stages write them -> one bundle of Parquet
    tables; returns the key report of what was written.

    Genotype and expression rows stay arrays of cells beside their sample names."""
    matrix = S.read_dosage_matrix(spark, genotype_path).joined().select(
        F.col("varid").alias("varID"), F.col("names").alias("samples"), F.col("fields").alias("dosages"))
    lines = read_lines(spark, expression_path, numbering="order").where(F.col("value") != "")
    cells = lines.select("file_path", F.regexp_extract("file_path", "/cell_type=([^/]+)/", 1).alias("cell_type"),
                         F.split("value", "\t").alias("f"))
    head = F.element_at("f", 1) == EXPORT_KEY
    headers = cells.where(head).select("file_path", F.col("f").alias("names")).distinct()
    expression = cells.where(~head).join(headers, "file_path").select(
        "cell_type", F.element_at("f", 1).alias(EXPORT_KEY), F.expr("slice(names, 2, size(names) - 1)").alias(
            "samples"), F.expr("slice(f, 2, size(f) - 1)").alias("cells"))
    return W.export_bundle(spark, out_dir, S.read_gene_annotation(spark, gene_annotation_path),
                           S.read_snp_annotation(spark, snp_path), matrix, expression, mode=mode)
