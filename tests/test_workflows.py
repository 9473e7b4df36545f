import glob
import gzip

from conftest import write

from twasprep.operators import predict as P
from twasprep.plans import workflows as WF
from twasprep.schemas import REGION_TENSORS


def _text(pattern):
    out = []
    for p in sorted(glob.glob(pattern, recursive=True)):
        opener = gzip.open if p.endswith(".gz") else open
        with opener(p, "rt") as fh:
            out.append(fh.read())
    return "".join(out)


def test_rsid_stage(spark, tmpdir_path):
    snp = write(tmpdir_path / "ann" / "chr1_annotation.txt",
                "chromosome\tpos\tvarID\tref_vcf\talt_vcf\tR2\tMAF\trsid\trsid_dbSNP150\n"
                "1\t100\t1_100_A_G\tA\tG\t1.0\t0.5\t.\t.\n"
                "1\t300\t1_300_G_T\tG\tT\t1.0\tNA\t.\t.\n")
    db = write(tmpdir_path / "dbsnp.vcf",
               "##x\n#CHROM\tPOS\tID\tREF\tALT\n1\t100\trs7\tA\tC,G\n1\t100\trs8\tA\tG\n")
    stats = WF.rsid_job(spark, snp, db, str(tmpdir_path / "out")).collect()
    assert [(r.chromosome, r.total, r.found) for r in stats] == [("1", 2, 1)]
    text = _text(str(tmpdir_path / "out" / "with_rsids" / "**" / "*.csv"))
    assert "1\t100\t1_100_A_G\tA\tG\t1.0\t0.5\trs7\trs7" in text
    assert "1\t300\t1_300_G_T\tG\tT\t1.0\t\t.\t." in text      # NA re-written empty


def test_features_prediction_expression_jobs(spark, tmpdir_path):
    tensors = spark.createDataFrame(
        [(s, f"chr1_{r}", [[float(r), 1.0 + k], [float(r), 3.0 + k]])
         for k, s in enumerate(["S1", "S2"]) for r in range(6)], REGION_TENSORS)
    tensors.write.parquet(str(tmpdir_path / "tensors"))
    write(tmpdir_path / "windows.csv",
          "gene_name,region_names\nGA,chr1_0|chr1_1\nGB,chr1_2|chr1_3|chr1_3\nGC,\nGD,chr1_5\n")
    WF.gene_features_job(spark, str(tmpdir_path / "tensors"), str(tmpdir_path / "windows.csv"),
                         str(tmpdir_path / "feat"))
    feats = spark.read.parquet(str(tmpdir_path / "feat" / "gene_features"))
    got = {(r.sample_id, r.gene_name): r.features for r in feats.collect()}
    assert got[("S1", "GA")] == [0.5, 2.0] and got[("S2", "GB")] == [2.5, 3.0]
    assert len(got) == 6
    manifest = str(tmpdir_path / "manifest")
    scorer = P.RuleLinearScorer(["neurons", "opc"])
    WF.prediction_job(spark, str(tmpdir_path / "feat" / "gene_features"), scorer,
                      str(tmpdir_path / "pred"), manifest_path=manifest)
    WF.prediction_job(spark, str(tmpdir_path / "feat" / "gene_features"), scorer,
                      str(tmpdir_path / "pred"), manifest_path=manifest)   # nothing pending
    preds = spark.read.parquet(str(tmpdir_path / "pred" / "predictions"))
    assert preds.count() == 6 * 2
    # per-sample prediction CSVs -> matrices -> PredictDB export
    pdir = tmpdir_path / "csv"
    write(pdir / "S1.csv", "gene_name,neurons_predicted,opc_predicted\nGA,1.0,2.0\nGB,3.0,4.0\n")
    write(pdir / "S2.csv", "gene_name,neurons_predicted\nGA,5.0\n")
    anno = write(tmpdir_path / "Gene_anno.txt", "chr\tgene_id\tgene_name\n1\tENSGA\tGA\n")
    unmapped = WF.expression_job(spark, str(pdir), ["S1", "S2", "S3"], anno,
                                 str(tmpdir_path / "expr"))
    assert sorted(r.gene_name for r in unmapped.collect()) == ["GB"]
    neurons = _text(str(tmpdir_path / "expr" / "predictdb" / "cell_type=neurons" / "*.csv.gz"))
    lines = neurons.splitlines()
    assert lines[0] == "NAME\tS1\tS2\tS3"
    assert any(ln.startswith("ENSGA\t") for ln in lines)
    assert any(ln.startswith("GB\t") for ln in lines)


def test_landed_dbsnp_and_genotypes(spark, tmpdir_path):
    snp = write(tmpdir_path / "ann" / "chr1_annotation.txt",
                "chromosome\tpos\tvarID\tref_vcf\talt_vcf\tR2\tMAF\trsid\trsid_dbSNP150\n"
                "1\t100\t1_100_A_G\tA\tG\t1.0\t0.5\t.\t.\n")
    db = write(tmpdir_path / "dbsnp.vcf",
               "##x\n#CHROM\tPOS\tID\tREF\tALT\n1\t100\trs7\tA\tC,G\n1\t100\trs8\tA\tG\n"
               "2\t5\trs9\tT\tC\n")
    WF.land_dbsnp(spark, db, str(tmpdir_path / "dbsnp_pq"))
    landed = spark.read.parquet(str(tmpdir_path / "dbsnp_pq"))
    assert landed.count() == 3
    stats = WF.rsid_job(spark, snp, str(tmpdir_path / "dbsnp_pq"), str(tmpdir_path / "out"),
                        dbsnp_format="parquet").collect()
    assert [(r.total, r.found) for r in stats] == [(1, 1)]
    text = _text(str(tmpdir_path / "out" / "with_rsids" / "**" / "*.csv"))
    assert "\trs7\trs7" in text
    vcf = write(tmpdir_path / "in" / "chr1.vcf",
                "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\n"
                "chr1\t100\t.\tA\tG\t.\t.\t.\tGT\t0|1\t1|1\n")
    samples = write(tmpdir_path / "samples.txt", "s2\ns1\n")
    WF.land_genotypes(spark, vcf, samples, str(tmpdir_path / "geno_pq"))
    g = spark.read.parquet(str(tmpdir_path / "geno_pq")).first()
    assert (g.varid, list(g.dosages), g.chrom) == ("chr1_100_A_G", [2, 1], "chr1")


def test_snp_annotation_from_vcf_job(spark, tmpdir_path):
    vcf = write(tmpdir_path / "in" / "chr1.vcf",
                "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\n"
                "chr1\t100\t.\tA\tG\t.\t.\t.\tGT\t0|1\t1|1\n"
                "chr1\t200\t.\tC\tT\t.\t.\t.\tGT\t0|0\t./.\n")
    samples = write(tmpdir_path / "samples.txt", "s1\ns2\n")
    out = str(tmpdir_path / "out")
    WF.snp_annotation_from_vcf(spark, vcf, samples, out)
    text = _text(f"{out}/snp_annotation/**/*.csv")
    assert "1\t100\t1_100_A_G_GRCh38\tA\tG\t1.0\t0.25\t.\t." in text
    assert "1\t200\t1_200_C_T_GRCh38\tC\tT\t1.0\t0.0\t.\t." in text
    assert spark.read.parquet(f"{out}/genotype_arrays").count() == 2


def test_validate_job_on_files(spark, tmpdir_path):
    m = tmpdir_path / "matrices"
    write(m / "neurons_predictions.csv", "gene_name,A,B\ng1,1.0,5.0\ng2,3.0,\n")
    write(m / "opc_predictions.csv", "junk\ngene_name,A,B\ng1,2.0,1.0\ng1,2.0,1.0\n")
    got = {r.cell_type: r for r in WF.validate_job(spark, str(m)).collect()}
    assert (got["neurons"].n_samples, got["neurons"].n_genes) == (2, 2)
    assert not got["neurons"].all_numeric and got["neurons"].no_duplicate_genes
    assert got["opc"].all_numeric and not got["opc"].no_duplicate_genes


def test_only_files_of_known_chromosomes_are_pruned(spark):
    from pyspark.sql import functions as F

    from twasprep.plans.workflows import _of_chromosomes

    read = ["chrAll_x", "chromosome_annot", "chr01_x", "chr1_x", "chrM_x", "chrMT_x", "all", "chrX_x"]
    paths = [f"file:/d/{n}.txt" for n in [*read, "chr2_x", "chr22_x", "chrY_x"]] + ["file:/d/chrom=chr3/p.txt"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    kept = [r["path"] for r in df.where(_of_chromosomes("1,X,MT")(F.col("path"))).collect()]
    assert sorted(kept) == sorted(paths[:len(read)])
