"""Command line entry points mirroring the original stage scripts.

    spark-submit --py-files twasprep.zip twasprep/cli.py <stage> [options]

(``twasprep.zip`` is the zipped package: workers import it to run scorers.)

Stages: extract, vcf-annotation, land-genotypes, maf, rsid, land-dbsnp,
gene-features, predict, rename, split, transform, bundle, validate. Each stage reads its inputs, runs the operators
and commits its output directory.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

if not __package__:  # started as a script: the package's parent is not on the path yet
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F

from twasprep.operators import manifest as MF
from twasprep.operators.bundle import inconsistencies
from twasprep.plans import keyed_jobs as KJ
from twasprep.plans import workflows as WF
from twasprep.plans.restart import read_attempts
from twasprep.session import build_session

#: Stages that are run, committed and repeated by key (file, chromosome, sample).
BY_KEY = ("extract", "maf", "rsid", "gene-features")
MANIFEST = "stage string, key string, status string, rows long"


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="twasprep")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="stage", required=True)

    s = sub.add_parser("extract", help="VCF -> dosage matrix + variant annotation")
    s.add_argument("--vcf", required=True, help="VCF path or glob (plain or bgzip)")
    s.add_argument("--samples", required=True, help="sample list, one id per line")
    s.add_argument("--output-dir", required=True)
    s.add_argument("--no-reformat", action="store_true", help="keep chr prefixes, no suffix")

    s = sub.add_parser("vcf-annotation",
                       help="VCF -> landed dosage arrays -> SNP annotation with MAF (no join)")
    s.add_argument("--vcf", required=True)
    s.add_argument("--samples", required=True)
    s.add_argument("--output-dir", required=True)
    s.add_argument("--no-reformat", action="store_true")

    s = sub.add_parser("land-genotypes", help="VCF -> array-layout Parquet by chromosome")
    s.add_argument("--split-gzip", action="store_true", help="several tasks per block-gzip file")
    s.add_argument("--vcf", required=True)
    s.add_argument("--samples", required=True)
    s.add_argument("--output-dir", required=True)

    s = sub.add_parser("maf", help="dosage matrix + annotation -> SNP annotation with MAF")
    s.add_argument("--genotype-dir", required=True)
    s.add_argument("--annotation-dir", required=True)
    s.add_argument("--output-dir", required=True)
    s.add_argument("--chromosomes", default="all", help="'all' or a comma list")

    s = sub.add_parser("rsid", help="SNP annotation + dbSNP -> rsIDs")
    s.add_argument("--input_dir", "--input-dir", dest="input_dir", required=True)
    s.add_argument("--output_dir", "--output-dir", dest="output_dir", required=True)
    s.add_argument("--dbsnp_vcf", "--dbsnp", dest="dbsnp", required=True)
    s.add_argument("--dbsnp-format", choices=["vcf", "parquet"], default="vcf")
    s.add_argument("--naming", choices=["strict", "normalized"], default="strict")

    s = sub.add_parser("land-dbsnp", help="dbSNP VCF -> chromosome-partitioned Parquet")
    s.add_argument("--dbsnp", required=True)
    s.add_argument("--output-dir", required=True)
    s.add_argument("--split-gzip", action="store_true", help="several tasks per block-gzip file")

    s = sub.add_parser("gene-features", help="region tensors -> gene mean features")
    s.add_argument("--tensors", required=True, help="Parquet region tensors")
    s.add_argument("--windows", required=True, help="gene windows CSV")
    s.add_argument("--output-dir", required=True)
    s.add_argument("--chunk-rows", type=int, default=None, help="legacy chunked means")

    s = sub.add_parser("predict", help="gene features -> predictions per cell type")
    s.add_argument("--features", required=True, help="gene features")
    s.add_argument("--features-format", choices=["parquet", "csv"], default="parquet")
    s.add_argument("--models", required=True, help="Parquet model weights table")
    s.add_argument("--output-dir", required=True)
    s.add_argument("--manifest", default=None)

    s = sub.add_parser("rename", help="legacy prediction column names -> *_predicted")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--output-dir", required=True)

    s = sub.add_parser("split", help="per-sample predictions -> per-cell-type matrices")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--input-format", choices=["csv", "parquet"], default="csv",
                   help="parquet: the output of predict")
    s.add_argument("--output-dir", required=True)

    s = sub.add_parser("transform", help="cell-type matrices -> PredictDB expression")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--gene-annotation", required=True)
    s.add_argument("--output-dir", required=True)

    s = sub.add_parser("bundle", help="the four trainer inputs -> one bundle and its key report")
    s.add_argument("--gene-annotation", required=True)
    s.add_argument("--snp-dir", required=True, help="SNP annotation with rsIDs")
    s.add_argument("--genotype-dir", required=True, help="dosage matrices")
    s.add_argument("--expression-dir", required=True, help="output of transform")
    s.add_argument("--output-dir", required=True)

    s = sub.add_parser("validate", help="check cell-type matrices")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--sample-rows", type=int, default=None)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(args.master, app_name=f"twasprep-{args.stage}")
    try:
        run(spark, args)
    finally:
        spark.stop()
    return 0


def run(spark, args: argparse.Namespace) -> None:
    """Run one parsed stage on an existing session, once.

    Attempts are kept in a table beside the output (``<output>.manifest``): a
    finished stage is skipped, one that was begun and not finished replaces its
    partial output, and output that no attempt wrote is never overwritten.
    ``predict`` keeps its own manifest per sample and always looks for new ones;
    the stages ``BY_KEY`` skip finished keys, record a failed one and go on, and
    print the summary.
    """
    out = getattr(args, "output_dir", None)
    if args.stage in BY_KEY:
        _stage_by_key(spark, args, f"{out.rstrip('/')}.manifest")
        return
    if out is None or args.stage == "predict":
        _stage(spark, args, "errorifexists")
        return
    path = f"{out.rstrip('/')}.manifest"
    inputs = spark.createDataFrame([(out,)], "key string")

    def record(status: str) -> None:
        spark.createDataFrame([(args.stage, out, status, None)], MANIFEST).coalesce(1) \
            .write.mode("append").parquet(path)

    begun = WF._exists(spark, path)
    if begun and MF.pending(inputs, spark.read.parquet(path), args.stage).isEmpty():
        print(f"{args.stage}: {out} is finished, skipped")
        return
    mode = "errorifexists"
    if begun and not spark.read.parquet(path).where(F.col("stage") == args.stage).isEmpty():
        mode = "overwrite"
    elif WF._exists(spark, out):
        raise FileExistsError(f"{out} holds files that no recorded attempt wrote")
    else:
        record("begun")
    try:
        _stage(spark, args, mode)
    except Exception:
        record("failed")
        raise
    record("success")
    MF.job_summary(inputs, spark.read.parquet(path), args.stage).show(truncate=False)


def _stage_by_key(spark, args: argparse.Namespace, attempts: str) -> None:
    out, before = args.output_dir, read_attempts(spark, attempts).count()
    if not before and WF._exists(spark, out):
        raise FileExistsError(f"{out} holds files that no recorded attempt wrote")
    if args.stage == "extract":
        summary = KJ.extract_by_file(spark, args.vcf, args.samples, out, attempts, reformat=not args.no_reformat)
    elif args.stage == "maf":
        summary = KJ.maf_by_chromosome(spark, args.genotype_dir, args.annotation_dir, out, attempts,
                                       args.chromosomes)
    elif args.stage == "rsid":
        summary, stats = KJ.rsid_by_file(spark, args.input_dir, args.dbsnp, out, attempts, naming=args.naming,
                                         dbsnp_format=args.dbsnp_format)
        stats.show(100, truncate=False)
    else:
        summary = KJ.gene_features_by_sample(spark, args.tensors, args.windows, out, attempts,
                                             chunk_rows=args.chunk_rows)
    after = read_attempts(spark, attempts)
    if before == after.count():
        print(f"{args.stage}: {out} is finished, skipped")
    summary.show(truncate=False)
    after.where((F.col("stage") == args.stage) & (F.col("status") == "failed")).select("key", "detail").show(
        100, truncate=False)


def _stage(spark, args: argparse.Namespace, mode: str) -> None:
    if args.stage == "vcf-annotation":
        WF.snp_annotation_from_vcf(spark, args.vcf, args.samples, args.output_dir,
                                   reformat=not args.no_reformat, mode=mode)
    elif args.stage == "land-genotypes":
        WF.land_genotypes(spark, args.vcf, args.samples, args.output_dir, mode=mode,
                          split_gzip=args.split_gzip)
    elif args.stage == "land-dbsnp":
        WF.land_dbsnp(spark, args.dbsnp, args.output_dir, mode=mode, split_gzip=args.split_gzip)
    elif args.stage == "predict":
        from twasprep.operators.predict import DenseStackScorer, read_model_weights

        scorer = DenseStackScorer.from_weights_table(read_model_weights(spark, args.models))
        WF.prediction_job(spark, args.features, scorer, args.output_dir, args.manifest,
                          args.features_format)
    elif args.stage == "rename":
        WF.rename_job(spark, args.input_dir, args.output_dir, mode=mode)
    elif args.stage == "split":
        WF.split_job(spark, args.input_dir, args.output_dir, mode=mode,
                     input_format=args.input_format)
    elif args.stage == "transform":
        WF.transform_job(spark, args.input_dir, args.gene_annotation, args.output_dir,
                         mode=mode).show(truncate=False)
    elif args.stage == "bundle":
        report = WF.bundle_job(spark, args.gene_annotation, args.snp_dir, args.genotype_dir,
                               args.expression_dir, args.output_dir, mode=mode)
        report.show(100, truncate=False)
        for r in inconsistencies(report).collect():
            print(f"bundle: {r.item} = {r.value}")
    elif args.stage == "validate":
        WF.validate_job(spark, args.input_dir, args.sample_rows).show(100, truncate=False)


def parse(argv: list[str]) -> argparse.Namespace:
    return _parser().parse_args(argv)


if __name__ == "__main__":
    sys.exit(main())
