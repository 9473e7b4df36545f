"""Registered queries: each builds its inputs from the benchmark tables with
Spark and runs one or more operators over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twasprep.operators import genotype as G
from twasprep.operators import features as FT
from twasprep.operators import expression as X
from twasprep.operators import manifest as MF
from twasprep.operators import predict as P
from twasprep.operators import rsid as R
from twasprep.operators import validate as VA
from twasprep.operators.bundle import bundle_report
from twasprep.plans import driver_views as V
from twasprep.plans.bucketed import (SAMPLE_PARTS, bucket_features, bucket_lookup, bucket_snps,
                                     resolve_bucketed)
from twasprep.plans.readers import QUERIES as READER_QUERIES
from twasprep.plans.restart import read_attempts, run_keys
from twasprep.plans.sink_queries import QUERIES as SINK_QUERIES
from twasprep.plans.tables import table_path
from twasprep.sinks import writers as W
from twasprep.sources import tables as S
from twasprep.sources.positions import add_positions, read_with_source
from twasprep.sources.text import list_files, sample_from_path
from twasprep.sources.vcf import parse_vcf

Query = Callable[[SparkSession, str], DataFrame]

# Sample list of the genotype queries: every sample, in a list order that is
# not alphabetical (output columns must follow the list, not the names).
GT_SAMPLE_ORDER = ["S03", "S01", "S07", "S00", "S05", "S02", "S06", "S04"]
# Chromosome selection of the filter query (a comma list, as on the CLI).
CHROMOSOME_SELECTION = "1,5,10,22"


def _samples(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(GT_SAMPLE_ORDER)), "ord int, sample_id string")


def q_dosage(spark, sf_dir):
    cells = V.gt_cells(spark, sf_dir)
    return G.dosage_from_gt(cells).select("varid", "chrom", "pos", "sample_id", "gt", "dosage")


def q_dosage_matrix(spark, sf_dir):
    d = G.dosage_from_gt(V.gt_cells(spark, sf_dir))
    return G.dosage_matrix(d, _samples(spark))


def q_varid_reformat(spark, sf_dir):
    ann = V.variant_annotation_rows(spark, sf_dir)
    out = ann.select(
        "varid",
        G.reformat_varid("varid").alias("varid_build"),
        G.reformat_varid(G.reformat_varid("varid")).alias("varid_twice"),
        G.reformat_varid(G.reformat_varid("varid"), idempotent=True).alias("varid_idempotent"),
        G.clean_chromosome("chrom").alias("chromosome"),
    )
    return out


def q_allele_counts(spark, sf_dir):
    return G.allele_counts(G.dosage_from_gt(V.gt_cells(spark, sf_dir)))


def _maf_annotation(spark, sf_dir):
    counts = G.allele_counts(G.dosage_from_gt(V.gt_cells(spark, sf_dir)))
    return G.annotate_maf(V.variant_annotation_rows(spark, sf_dir), G.maf_table(counts))


def q_maf_annotation(spark, sf_dir):
    return _maf_annotation(spark, sf_dir)


def q_chromosome_order(spark, sf_dir):
    return G.chromosome_order(_maf_annotation(spark, sf_dir), "chromosome")


def q_chromosome_filter(spark, sf_dir):
    return G.maf_annotation_of(V.gt_cells(spark, sf_dir), V.variant_annotation_rows(spark, sf_dir),
                               CHROMOSOME_SELECTION)


def _materialised(df: DataFrame) -> DataFrame:
    """Rendered text is read twice (header pass and record pass), like a file
    on disk: write it once as a table under the shared checkpoint folder and
    read it back (one computation, lineage cut) instead of recomputing the
    rendering for each pass."""
    path = table_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def q_vcf_dosages(spark, sf_dir):
    vcf = parse_vcf(_materialised(V.vcf_lines(spark, sf_dir)))
    arrays = G.extract_dosages(vcf, _samples(spark))
    return G.dosages_long(arrays, _samples(spark)).select("varid", "sample_id", "dosage")


def q_vcf_snp_annotation(spark, sf_dir):
    vcf = parse_vcf(_materialised(V.vcf_lines(spark, sf_dir)))
    arrays = G.extract_dosages(vcf, _samples(spark))
    return G.snp_annotation_from_vcf_arrays(arrays)


def q_matrix_maf_annotation(spark, sf_dir):
    matrix = S.parse_dosage_matrix(V.matrix_lines_rendered(spark, sf_dir, GT_SAMPLE_ORDER))
    ann = S.parse_variant_annotation(V.annotation_lines_rendered(spark, sf_dir))
    return G.annotate_maf(ann, G.maf_table(G.matrix_allele_counts(matrix)))


def q_dosage_matrix_text(spark, sf_dir):
    d = G.dosage_from_gt(V.gt_cells(spark, sf_dir))
    arrays = G.dosage_arrays(d, _samples(spark))
    return G.matrix_lines(arrays, keep=["varid"])


def q_snp_annotation_text(spark, sf_dir):
    return W.snp_annotation_lines(_maf_annotation(spark, sf_dir))


def q_rsid_resolve(spark, sf_dir):
    return R.resolve_rsids(V.snp_annotation_rows(spark, sf_dir), V.dbsnp_rows(spark, sf_dir))


def q_rsid_resolve_normalized(spark, sf_dir):
    return R.resolve_rsids(V.snp_annotation_rows(spark, sf_dir), V.dbsnp_rows(spark, sf_dir),
                           naming="normalized")


def q_rsid_stats(spark, sf_dir):
    resolved = R.resolve_rsids(V.snp_annotation_rows(spark, sf_dir), V.dbsnp_rows(spark, sf_dir),
                               with_flag=True)
    return R.rsid_stats(resolved)


def q_rsid_legacy_fill(spark, sf_dir):
    return R.resolve_rsids(V.snp_annotation_rows(spark, sf_dir), V.dbsnp_rows(spark, sf_dir),
                           legacy_fill=True)


def q_rsid_naming_report(spark, sf_dir):
    return R.rsid_naming_report(V.snp_annotation_rows(spark, sf_dir), V.dbsnp_rows(spark, sf_dir))


def q_rsid_overlap(spark, sf_dir):
    return R.overlapping_records(V.snp_annotation_rows(spark, sf_dir),
                                 V.dbsnp_with_long_deletions(spark, sf_dir))


#: Buckets of the co-partitioned queries (a cluster takes a multiple of its cores).
BUCKETS = 8


def q_rsid_bucketed(spark, sf_dir):
    base = table_path(spark)
    lookup = bucket_lookup(V.dbsnp_rows(spark, sf_dir), f"{base}/lookup", BUCKETS)
    snps = bucket_snps(V.snp_annotation_rows(spark, sf_dir), f"{base}/snps", BUCKETS)
    return resolve_bucketed(snps, lookup)


# Rows per chunk in the legacy chunked mean (small, so genes straddle chunks).
CHUNK_ROWS = 25
# Digits kept on vector elements in the exploded (comparable) outputs.
VALUE_DIGITS = 6


def explode_vector(df: DataFrame, keys: list[str], col: str = "features") -> DataFrame:
    """Array column -> ``(keys..., idx, value)`` rows, value rounded."""
    return df.select(*keys, F.posexplode(col).alias("idx", "_v")) \
        .select(*keys, "idx", F.round("_v", VALUE_DIGITS).alias("value"))


def q_bin_means(spark, sf_dir):
    means = FT.region_bin_means(V.region_tensors(spark, sf_dir))
    return explode_vector(means, ["sample_id", "region", "chromo"])


def q_gene_region_means(spark, sf_dir):
    m = FT.gene_region_means(V.gene_windows(spark, sf_dir), V.region_features(spark, sf_dir))
    return explode_vector(m, ["sample_id", "gene_name"])


def q_gene_region_means_chunked(spark, sf_dir):
    m = FT.gene_region_means(V.gene_windows(spark, sf_dir), V.region_features(spark, sf_dir),
                             chunk_rows=CHUNK_ROWS)
    return explode_vector(m, ["sample_id", "chunk", "gene_name"])


def _feature_files(spark, sf_dir):
    """Region features as Parquet files in which the samples mix: one small file
    of the first rows, then larger ones that a scan takes first."""
    rows = V.region_features(spark, sf_dir)
    base = table_path(spark)
    first, rest = rows.where(F.col("ord") < 7), rows.where(F.col("ord") >= 7)
    for name, part, files in (("a", first, 1), ("b", rest, 3)):
        # ranges of the row order: part files follow each other by name
        part.repartitionByRange(files, "ord").sortWithinPartitions("ord", "sample_id").drop("ord") \
            .write.parquet(f"{base}/{name}")
    return [f"{base}/a", f"{base}/b"]


def q_chunked_from_files(spark, sf_dir):
    feats = add_positions(read_with_source(spark, _feature_files(spark, sf_dir)))
    m = FT.gene_region_means(V.gene_windows(spark, sf_dir), feats, chunk_rows=CHUNK_ROWS)
    return explode_vector(m, ["sample_id", "chunk", "gene_name"])


def q_first_chunk_means(spark, sf_dir):
    m = FT.first_chunk_means(V.gene_windows(spark, sf_dir), V.region_features(spark, sf_dir),
                             CHUNK_ROWS)
    return explode_vector(m, ["sample_id", "gene_name"])


def q_keep_first(spark, sf_dir):
    return P.keep_first_gene(V.event_rows(spark, sf_dir))


def q_duplicate_report(spark, sf_dir):
    return P.duplicate_report(V.event_rows(spark, sf_dir))


def q_feature_zscore(spark, sf_dir):
    z = P.zscore_features(V.gene_features(spark, sf_dir))
    return explode_vector(z, ["sample_id", "gene_name"])


def q_feature_zscore_bucketed(spark, sf_dir):
    table = bucket_features(V.gene_features(spark, sf_dir), f"{table_path(spark)}/features", BUCKETS)
    return explode_vector(P.zscore_bucketed(table, SAMPLE_PARTS), ["sample_id", "gene_name"])


def q_predict_expression(spark, sf_dir):
    z = P.zscore_features(V.gene_features(spark, sf_dir))
    pred = P.predict_expression(z, P.RuleLinearScorer())
    return pred.withColumn("prediction", F.round("prediction", VALUE_DIGITS))


def q_row_conservation(spark, sf_dir):
    feats = V.gene_features(spark, sf_dir)
    scorer = P.RuleLinearScorer()
    preds = P.predict_expression(P.zscore_features(feats), scorer)
    return P.row_conservation(P.distinct_genes(feats), preds, len(scorer.cell_types))


def q_streamed_scores(spark, sf_dir):
    """The feature rows land as several files a sample and are scored as a stream."""
    from twasprep.streaming.landing import stream_scores

    base = table_path(spark)
    V.gene_features(spark, sf_dir).repartition(3, "ord").write.partitionBy("sample_id").parquet(f"{base}/in")
    expected = list_files(spark, f"{base}/in", "*.parquet", recursive=True).groupBy(
        sample_from_path("path").alias("sample_id")).agg(F.count(F.lit(1)).alias("files"))
    state = stream_scores(spark, f"{base}/in", expected, P.RuleLinearScorer(), f"{base}/out", f"{base}/check",
                          max_files_per_trigger=16)
    return state.predictions().drop("batch").withColumn("prediction", F.round("prediction", VALUE_DIGITS))


def q_predictions_long(spark, sf_dir):
    return X.predictions_long(V.event_predictions_wide(spark, sf_dir), V.EVENT_CELL_TYPES)


def _event_matrix(spark, sf_dir):
    long = X.predictions_long(V.event_predictions_wide(spark, sf_dir), V.EVENT_CELL_TYPES)
    return X.cell_type_matrix(long, V.EVENT_SAMPLES)


def q_cell_type_matrix(spark, sf_dir):
    return _event_matrix(spark, sf_dir)


def q_combine_predictions(spark, sf_dir):
    ev = V.event_rows(spark, sf_dir)
    tables = []
    for ct in [c for c in V.EVENT_CELL_TYPES if c != "refund"]:
        t = (ev.where(F.col("sample_id") == ct)
             .groupBy(F.col("gene_name"))
             .agg(F.max_by("value", "ord").alias(f"{ct}_mean_expression_predicted_expression")))
        tables.append(t)
    return P.combine_predictions(tables, ["gene_name"])


def q_rename_columns(spark, sf_dir):
    return X.rename_predictions(V.legacy_named_wide(spark, sf_dir))


def q_gene_id_map(spark, sf_dir):
    return X.to_predictdb_expression(V.expression_matrix(spark, sf_dir),
                                     V.gene_annotation_rows(spark, sf_dir))


def q_unmapped_genes(spark, sf_dir):
    return X.unmapped_genes(V.expression_matrix(spark, sf_dir),
                            V.gene_annotation_rows(spark, sf_dir))


def q_bundle_report(spark, sf_dir):
    """Variants are missing on either side and repeat among the genotypes; genes are
    those of the expression export and the annotation it was mapped by."""
    ann = V.variant_annotation_rows(spark, sf_dir).select(F.col("varid").alias("varID"), "pos")
    genotype = ann.where(F.col("pos") % 110 != 0).unionByName(ann.where(F.col("pos") % 130 == 0))
    genes = V.gene_annotation_rows(spark, sf_dir)
    expression = X.to_predictdb_expression(V.expression_matrix(spark, sf_dir), genes)
    return bundle_report(genes, ann.where(F.col("pos") % 70 != 0), genotype, expression)


def q_cell_type_matrix_text(spark, sf_dir):
    long = X.predictions_long(V.event_predictions_wide(spark, sf_dir), V.EVENT_CELL_TYPES)
    return X.cell_type_matrix_lines(long, V.EVENT_SAMPLES)


def q_unmapped_summary(spark, sf_dir):
    return X.unmapped_summary(X.unmapped_genes(V.expression_matrix(spark, sf_dir),
                                               V.gene_annotation_rows(spark, sf_dir)))


def q_matrix_checks(spark, sf_dir):
    return VA.validate_matrix(_event_matrix(spark, sf_dir), group_by=["cell_type"])


def q_pending_outputs(spark, sf_dir):
    return MF.pending(V.manifest_inputs(spark, sf_dir), V.manifest_rows(spark, sf_dir), "predict")


def q_job_summary(spark, sf_dir):
    return MF.job_summary(V.manifest_inputs(spark, sf_dir), V.manifest_rows(spark, sf_dir),
                          "predict")


#: Keys of the restart query that an earlier run has done, and one that fails at first.
DONE_BEFORE, FAIL_AT_FIRST = ("Brand#11", "Brand#12"), "Brand#25"


def q_stage_attempts(spark, sf_dir):
    """Parts written brand by brand in two runs: brands that are done are skipped,
    one fails in the first run and succeeds in the second, the rest run once."""
    part = V.table(spark, sf_dir, "part")
    keys = part.select(F.col("p_brand").alias("key")).distinct()
    base = table_path(spark)
    out, attempts = f"{base}/out", f"{base}/attempts"
    keys.where(F.col("key").isin(*DONE_BEFORE)).select(
        F.lit("load").alias("stage"), "key", F.lit("success").alias("status"),
        F.lit(0).cast("long").alias("rows"), F.lit(None).cast("string").alias("detail")) \
        .write.parquet(attempts)

    def load(bad):
        def work(batch):
            value = F.col("p_partkey")
            if bad:
                value = F.when(F.col("p_brand") == bad, F.raise_error(F.lit("bad part"))).otherwise(value)
            rows = part.join(batch, part["p_brand"] == batch["key"], "left_semi")
            (rows.select(F.col("p_brand").alias("key"), value.alias("part")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("key").parquet(out))
            written = spark.read.parquet(out).withColumn("key", F.col("key").cast("string"))
            return written.join(batch, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
        return work

    run_keys(keys, "load", attempts, load(FAIL_AT_FIRST))
    run_keys(keys, "load", attempts, load(None))
    done = F.col("status") == "success"
    return read_attempts(spark, attempts).groupBy("key").agg(
        F.count_if(done).alias("done"), F.count_if(~done).alias("failed"), F.sum("rows").alias("rows"))


QUERIES: dict[str, Query] = {
    "maf_annotation": q_maf_annotation,
    "dosage": q_dosage,
    "dosage_matrix": q_dosage_matrix,
    "varid_reformat": q_varid_reformat,
    "allele_counts": q_allele_counts,
    "chromosome_order": q_chromosome_order,
    "chromosome_filter": q_chromosome_filter,
    "vcf_dosages": q_vcf_dosages,
    "vcf_snp_annotation": q_vcf_snp_annotation,
    "matrix_maf_annotation": q_matrix_maf_annotation,
    "dosage_matrix_text": q_dosage_matrix_text,
    "snp_annotation_text": q_snp_annotation_text,
    "rsid_resolve": q_rsid_resolve,
    "rsid_resolve_normalized": q_rsid_resolve_normalized,
    "rsid_stats": q_rsid_stats,
    "rsid_legacy_fill": q_rsid_legacy_fill,
    "rsid_naming_report": q_rsid_naming_report,
    "rsid_overlap": q_rsid_overlap,
    "rsid_bucketed": q_rsid_bucketed,
    "bin_means": q_bin_means,
    "gene_region_means": q_gene_region_means,
    "gene_region_means_chunked": q_gene_region_means_chunked,
    "chunked_from_files": q_chunked_from_files,
    "first_chunk_means": q_first_chunk_means,
    "keep_first": q_keep_first,
    "duplicate_report": q_duplicate_report,
    "feature_zscore": q_feature_zscore,
    "feature_zscore_bucketed": q_feature_zscore_bucketed,
    "predict_expression": q_predict_expression,
    "row_conservation": q_row_conservation,
    "streamed_scores": q_streamed_scores,
    "predictions_long": q_predictions_long,
    "cell_type_matrix": q_cell_type_matrix,
    "combine_predictions": q_combine_predictions,
    "rename_columns": q_rename_columns,
    "gene_id_map": q_gene_id_map,
    "unmapped_genes": q_unmapped_genes,
    "cell_type_matrix_text": q_cell_type_matrix_text,
    "unmapped_summary": q_unmapped_summary,
    "matrix_checks": q_matrix_checks,
    "bundle_report": q_bundle_report,
    "pending_outputs": q_pending_outputs,
    "job_summary": q_job_summary,
    "stage_attempts": q_stage_attempts,
}
QUERIES.update(READER_QUERIES)
QUERIES.update(SINK_QUERIES)
