"""The ledger of written files, and the bundle stage with its key report."""

import glob
import gzip
import os

from conftest import write

from twasprep import cli
from twasprep.operators.bundle import bundle_report, inconsistencies
from twasprep.sinks import ledger as L
from twasprep.sinks import writers as W


def _frame(spark):
    return spark.createDataFrame(
        [("A", "g1", [1.0, 2.0]), ("A", "g2", [0.5, None]), ("B", "g1", [3.0, float("nan")])],
        "sample_id string, gene_name string, features array<double>")


def test_ledger_finds_what_changed(spark, tmpdir_path):
    path = str(tmpdir_path / "f")
    W.write_gene_features(_frame(spark), path, fmt="csv", width=2)
    L.file_ledger(spark, path).write.parquet(str(tmpdir_path / "ledger"))
    kept = spark.read.parquet(str(tmpdir_path / "ledger"))
    assert {r.header for r in kept.collect()} == {"gene_name,0,1"} and sum(r.rows for r in kept.collect()) == 3
    assert L.changed_files(kept, L.file_ledger(spark, path)).isEmpty()
    a = glob.glob(f"{path}/sample_id=A/*.csv.gz")
    text = gzip.open(a[0], "rt").read()
    with gzip.open(f"{path}/sample_id=B/part-extra.csv.gz", "wt") as f:
        f.write("gene_name,0,1\n")
    for crc in glob.glob(f"{path}/sample_id=A/.*.crc"):
        os.remove(crc)
    with gzip.open(a[0], "wt") as f:
        f.write(text.replace("g1,1.0", "g1,1.5"))
    got = {r.path.rsplit("/", 2)[1]: r.change for r in L.changed_files(kept, L.file_ledger(spark, path)).collect()}
    assert got == {"sample_id=A": "changed", "sample_id=B": "new"}
    digest = {r.part: (r.rows, r.checksum) for r in L.text_digest(spark, path, "sample_id").collect()}
    assert digest["A"][0] == 2 and digest["B"][0] == 1


def test_digest_does_not_depend_on_the_part_files(spark, tmpdir_path):
    for n in (1, 3):
        W.write_gene_features(_frame(spark).repartition(n), str(tmpdir_path / f"f{n}"), fmt="csv", width=2)
    one, three = (sorted(map(tuple, L.text_digest(spark, str(tmpdir_path / f"f{n}"), "sample_id").collect()))
                  for n in (1, 3))
    assert one == three and [r[0] for r in one] == ["A", "B"]


def test_bundle_counts_both_directions_and_repeats(spark):
    ga = spark.createDataFrame([("E1", "A"), ("E1", "B"), ("E2", "C"), (None, "D")], "ensembl_id string, gene_name string")
    sa = spark.createDataFrame([("v1",), ("v2",), ("v2",)], "varID string")
    gt = spark.createDataFrame([("v2",), ("v3",)], "varid string")
    ex = spark.createDataFrame([("E2",), ("E9",), ("E9",)], "NAME string")
    rep = {r.item: r.value for r in bundle_report(ga, sa, gt, ex).collect()}
    assert rep["gene_annotation_rows"] == 4 and rep["gene_annotation_keys"] == 3
    assert (rep["gene_annotation_repeated_keys"], rep["expression_repeated_keys"]) == (1, 1)
    assert (rep["gene_annotation_keys_not_in_expression"], rep["expression_keys_not_in_gene_annotation"]) == (2, 1)
    assert (rep["snp_annotation_keys_not_in_genotype"], rep["genotype_keys_not_in_snp_annotation"]) == (1, 1)
    assert rep["snp_annotation_repeated_keys"] == 1 and rep["genotype_repeated_keys"] == 0
    bad = {r.item for r in inconsistencies(bundle_report(ga, sa, gt, ex)).collect()}
    assert "genotype_keys_not_in_snp_annotation" in bad and "genotype_rows" not in bad
    empty = [df.limit(0) for df in (ga, sa, gt, ex)]
    assert all(r.value == 0 for r in bundle_report(*empty).collect())


def test_bundle_stage_on_the_stages_outputs(spark, tmpdir_path, capsys):
    d = tmpdir_path
    anno = write(d / "Gene_anno.txt", "chr\tgene_id\tgene_name\n1\tENSG1\tg1\n1\tENSG2\tg2\n")
    write(d / "m" / "neurons_predictions.csv", "gene_name,A,B\ng1,1.0,5.0\ng9,3.0,\n")
    write(d / "snp" / "chr1_annotation.txt",
          "chromosome\tpos\tvarID\tref_vcf\talt_vcf\tR2\tMAF\trsid\trsid_dbSNP150\n"
          "1\t100\tv1\tA\tG\t1.0\t0.5\t.\t.\n1\t200\tv2\tA\tG\t1.0\t0.5\t.\t.\n")
    write(d / "geno" / "chr1.txt", "varID\tA\tB\nv1\t0\t1\n")
    run = lambda *argv: cli.run(spark, cli.parse([str(a) for a in argv]))
    run("transform", "--input-dir", d / "m", "--gene-annotation", anno, "--output-dir", d / "pdb")
    capsys.readouterr()
    run("bundle", "--gene-annotation", anno, "--snp-dir", d / "snp", "--genotype-dir", d / "geno",
        "--expression-dir", d / "pdb", "--output-dir", d / "bundle")
    out = capsys.readouterr().out
    assert "bundle: snp_annotation_keys_not_in_genotype = 1" in out
    assert "bundle: expression_keys_not_in_gene_annotation = 1" in out and "genotype_keys_not_in" in out
    ex = {r.NAME: (r.samples, r.cells, r.cell_type) for r in spark.read.parquet(f"{d}/bundle/expression").collect()}
    assert ex["ENSG1"] == (["A", "B"], ["1.0", "5.0"], "neurons") and set(ex) == {"ENSG1", "g9"}
    gt = spark.read.parquet(f"{d}/bundle/genotype").first()
    assert (gt.varID, gt.samples, gt.dosages) == ("v1", ["A", "B"], ["0", "1"])
