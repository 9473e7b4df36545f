"""Tensors to PredictDB expression on the stages' own outputs, and reruns."""

import glob
import gzip
import os

import pytest

from conftest import write
from twasprep import cli
from twasprep.operators import rsid as R
from twasprep.operators import validate as VA
from twasprep.sources import tables as S


def _stage(spark, *argv):
    cli.run(spark, cli.parse([str(a) for a in argv]))


def test_tensors_to_predictdb_twice(spark, tmpdir_path, capsys):
    t = tmpdir_path
    rows = [(s, f"chr1_{i}_{i + 1}", [[float(i + k), 1.0 * i * k]] * 2) for k, s in
            enumerate(("007", "008"), 1) for i in range(4)]
    spark.createDataFrame(rows, "sample_id string, region string, bins array<array<float>>") \
        .write.parquet(str(t / "tensors"))
    windows = write(t / "w.csv", "gene_name,region_names\nG1,chr1_0_1|chr1_1_2\nG2,chr1_2_3|chr1_3_4\n")
    spark.createDataFrame([("neurons", 0, [[1.0, 0.5]], [0.1]), ("opc", 0, [[0.0, 1.0]], [0.0])],
                          "cell_type string, layer int, weights array<array<double>>, bias array<double>") \
        .write.parquet(str(t / "models"))
    anno = write(t / "Gene_anno.txt", "chr\tgene_id\tgene_name\n1\tENSG1\tG1\n")

    def chain():
        _stage(spark, "gene-features", "--tensors", t / "tensors", "--windows", windows,
               "--output-dir", t / "feats")
        _stage(spark, "predict", "--features", t / "feats" / "gene_features", "--models", t / "models",
               "--output-dir", t / "pred", "--manifest", t / "pred_manifest")
        _stage(spark, "split", "--input-dir", t / "pred" / "predictions", "--input-format", "parquet",
               "--output-dir", t / "mats")
        _stage(spark, "transform", "--input-dir", t / "mats", "--gene-annotation", anno,
               "--output-dir", t / "pdb")
        return {p: os.path.getmtime(p) for p in glob.glob(str(t / "**" / "part-*"), recursive=True)
                if ".manifest" not in p and "pred_manifest" not in p}

    first = chain()
    text = "".join(gzip.open(p, "rt").read() for p in glob.glob(str(t / "pdb" / "cell_type=opc" / "*.gz")))
    assert text.splitlines()[0] == "NAME\t007\t008"
    assert {ln.split("\t")[0] for ln in text.splitlines()} == {"NAME", "ENSG1", "G2"}
    capsys.readouterr()
    assert chain() == first                       # nothing is written again
    assert capsys.readouterr().out.count("skipped") == 3


def test_unknown_output_is_not_overwritten_and_a_failed_stage_can_be_repeated(spark, tmpdir_path):
    d = tmpdir_path
    write(d / "in" / "A.csv", "gene_name,neurons_predicted\ng1,1.0\n")
    write(d / "out" / "mine.txt", "keep\n")
    for _ in range(2):
        with pytest.raises(Exception):
            _stage(spark, "rename", "--input-dir", d / "in", "--output-dir", d / "out")
        assert (d / "out" / "mine.txt").read_text() == "keep\n"
    with pytest.raises(Exception):
        _stage(spark, "rename", "--input-dir", d / "none", "--output-dir", d / "o2")
    write(d / "none" / "A.csv", "gene_name,neurons_predicted,x\ng1,1.0,a\ng1,2.50,b\n")
    _stage(spark, "rename", "--input-dir", d / "none", "--output-dir", d / "o2")
    text = "".join(open(p).read() for p in glob.glob(str(d / "o2" / "sample_id=A" / "*.csv")))
    assert text == "gene_name,neurons_predicted,x\ng1,1.0,a\ng1,2.50,b\n"


def test_annotation_without_id_columns_is_resolved(spark, tmpdir_path):
    p = write(tmpdir_path / "a.txt", "pos\tchromosome\tvarID\talt_vcf\tref_vcf\n5\t1\tv\tG\tA\n")
    db = spark.createDataFrame([("1", 5, "rs9", "A", "G", 1)],
                               "chrom string, pos long, rsid string, ref string, alt string, ord long")
    row = R.resolve_rsids(S.read_snp_annotation(spark, p), db).first()
    assert (row.rsid, row.rsid_dbSNP150, row.MAF) == ("rs9", "rs9", None)
    bad = write(tmpdir_path / "b.txt", "5\t1\tv\tG\tA\n")
    with pytest.raises(Exception, match="without a header"):
        S.read_snp_annotation(spark, bad).collect()


def test_repeated_variant_ids_do_not_multiply_hits(spark):
    snps = spark.createDataFrame([("v", "1", 5), ("v", "1", 5), ("w", "1", 5)],
                                 "varID string, chromosome string, pos long")
    db = spark.createDataFrame([("1", 5, "rs1", "A", "G", 1)],
                               "chrom string, pos long, rsid string, ref string, alt string, ord long")
    got = sorted(tuple(r) for r in R.rsid_naming_report(snps, db).collect())
    assert got == [("v", 1, 0, "bare", "rs1")] * 2 + [("w", 1, 0, "bare", "rs1")]


def test_matrix_files_with_their_own_headers(spark, tmpdir_path):
    m = tmpdir_path / "m"
    write(m / "a_predictions.csv", "gene_name,A,A\ng1,1,2\n")
    write(m / "b_predictions.csv", "gene_name,B\ng1,1\ng2,x,3\n,4\n")
    write(m / "c_predictions.csv", "no header\n")
    got = {r.cell_type: r for r in VA.validate_files(S.read_cell_type_matrix(spark, str(m))).collect()}
    assert not got["a"].no_duplicate_columns and got["a"].all_numeric
    assert not got["b"].all_numeric and not got["b"].no_missing_genes and got["b"].n_genes == 3
    assert not got["c"].has_gene_name and got["c"].n_genes == 0
    anno = write(tmpdir_path / "g.txt", "chr\tid\tname\n1\tE1\tg1\n")
    from twasprep.plans import workflows as WF

    WF.transform_job(spark, str(m), anno, str(tmpdir_path / "o"), manifest_path=str(tmpdir_path / "mf"))
    status = {r.key: r.status for r in spark.read.parquet(str(tmpdir_path / "mf")).collect()}
    assert status == {"a": "success", "b": "success", "c": "failed"}
