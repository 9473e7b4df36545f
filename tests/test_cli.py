import glob
import gzip

from conftest import write

from twasprep import cli

VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\ts3
chr1\t100\t.\tA\tG\t.\tPASS\t.\tGT\t0|0\t0|1\t1|1
chr1\t200\t.\tC\tT\t.\tPASS\t.\tGT\t1|1\t1|1\t0|1
"""


def _text(pattern):
    out = []
    for p in sorted(glob.glob(pattern, recursive=True)):
        opener = gzip.open if p.endswith(".gz") else open
        with opener(p, "rt") as fh:
            out.append(fh.read())
    return "".join(out)


def test_cli_genotype_stages(spark, tmpdir_path):
    vcf = write(tmpdir_path / "vcf" / "chr1.vcf", VCF)
    samples = write(tmpdir_path / "samples.txt", "s1\ns2\ns3\n")
    out = str(tmpdir_path / "g")
    cli.run(spark, cli.parse(["extract", "--vcf", vcf, "--samples", samples, "--output-dir", out]))
    cli.run(spark, cli.parse(["maf", "--genotype-dir", f"{out}/genotype", "--annotation-dir",
                              f"{out}/variant_annotation", "--output-dir", f"{out}/snp",
                              "--chromosomes", "1"]))
    snp = _text(f"{out}/snp/**/*.csv")
    assert "1\t100\t1_100_A_G_GRCh38\tA\tG\t1.0\t0.5\t.\t." in snp
    assert "1\t200\t1_200_C_T_GRCh38\tC\tT\t1.0\t0.16667\t.\t." in snp


def test_cli_expression_stages(spark, tmpdir_path):
    legacy = "_mean_expression_mean_expression_predicted_expression"
    d = tmpdir_path / "pred"
    write(d / "A.csv", f"gene_name,neurons{legacy},opc{legacy}\ng1,1.0,2.0\ng2,3.0,4.0\n")
    write(d / "B.csv", f"gene_name,neurons{legacy}\ng1,5.0\n")
    cli.run(spark, cli.parse(["rename", "--input-dir", str(d), "--output-dir",
                              str(tmpdir_path / "renamed")]))
    renamed = spark.read.option("header", "true").csv(str(tmpdir_path / "renamed"))
    assert "neurons_predicted" in renamed.columns and renamed.count() == 3
    d2 = tmpdir_path / "pred2"
    write(d2 / "A.csv", "gene_name,neurons_predicted,opc_predicted\ng1,1.0,2.0\ng2,3.0,4.0\n")
    write(d2 / "B.csv", "gene_name,neurons_predicted\ng1,5.0\n")
    cli.run(spark, cli.parse(["split", "--input-dir", str(d2), "--output-dir",
                              str(tmpdir_path / "mat")]))
    neurons = _text(str(tmpdir_path / "mat" / "cell_type=neurons" / "*.csv"))
    assert neurons.splitlines()[0] == "gene_name,A,B" and "g1,1.0,5.0" in neurons
    # the transform stage reads matrices laid out one file per cell type
    m = tmpdir_path / "matrices"
    write(m / "neurons_predictions.csv", "gene_name,A,B\ng1,1.0,5.0\ng2,3.0,\n")
    write(m / "opc_predictions.csv", "junk\ngene_name,A,B\ng1,2.0,\n")
    anno = write(tmpdir_path / "Gene_anno.txt", "chr\tgene_id\tgene_name\n1\tENSG1\tg1\n")
    cli.run(spark, cli.parse(["transform", "--input-dir", str(m), "--gene-annotation", anno,
                              "--output-dir", str(tmpdir_path / "pdb")]))
    ptxt = _text(str(tmpdir_path / "pdb" / "cell_type=neurons" / "*.csv.gz"))
    assert ptxt.splitlines()[0] == "NAME\tA\tB"
    assert "ENSG1\t1.0\t5.0" in ptxt and "g2\t3.0\t" in ptxt
    cli.run(spark, cli.parse(["validate", "--input-dir", str(m)]))


def test_cli_stages_chain_on_own_outputs(spark, tmpdir_path):
    legacy = "_mean_expression_mean_expression_predicted_expression"
    d = tmpdir_path / "pred"
    write(d / "A.csv_predicted_expressions.csv", f"gene_name,neurons{legacy}\ng1,1.0\ng2,2.0\n")
    write(d / "B.csv_predicted_expressions.csv", f"gene_name,neurons{legacy}\ng1,3.0\n")
    renamed, mats, pdb = (str(tmpdir_path / x) for x in ("renamed", "mats", "pdb"))
    cli.run(spark, cli.parse(["rename", "--input-dir", str(d), "--output-dir", renamed]))
    cli.run(spark, cli.parse(["split", "--input-dir", renamed, "--output-dir", mats]))
    text = _text(f"{mats}/cell_type=neurons/*.csv")
    assert text.splitlines()[0] == "gene_name,A,B" and "g1,1.0,3.0" in text and "g2,2.0," in text
    anno = write(tmpdir_path / "Gene_anno.txt", "chr\tgene_id\tgene_name\n1\tENSG2\tg2\n")
    cli.run(spark, cli.parse(["transform", "--input-dir", mats, "--gene-annotation", anno,
                              "--output-dir", pdb]))
    ptxt = _text(f"{pdb}/cell_type=neurons/*.csv.gz")
    assert ptxt.splitlines()[0] == "NAME\tA\tB" and "ENSG2\t2.0\t" in ptxt


def test_cli_vcf_annotation_and_landing(spark, tmpdir_path):
    vcf = write(tmpdir_path / "vcf" / "chr1.vcf", VCF)
    samples = write(tmpdir_path / "samples.txt", "s1\ns2\ns3\n")
    out = str(tmpdir_path / "va")
    cli.run(spark, cli.parse(["vcf-annotation", "--vcf", vcf, "--samples", samples,
                              "--output-dir", out]))
    assert "1\t200\t1_200_C_T_GRCh38\tC\tT\t1.0\t0.16667\t.\t." in _text(
        f"{out}/snp_annotation/**/*.csv")
    cli.run(spark, cli.parse(["land-genotypes", "--vcf", vcf, "--samples", samples,
                              "--output-dir", str(tmpdir_path / "landed")]))
    assert spark.read.parquet(str(tmpdir_path / "landed")).count() == 2
