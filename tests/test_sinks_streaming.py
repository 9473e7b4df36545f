import glob
import gzip

from conftest import write
from pyspark.sql import functions as F

from twasprep.operators import common as C
from twasprep.operators import features as FT
from twasprep.plans import workflows as WF
from twasprep.schemas import REGION_TENSORS
from twasprep.sinks import writers as W
from twasprep.streaming import landing as L

VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\ts3\ts4
chr1\t100\t.\tA\tG\t.\tPASS\t.\tGT\t0|0\t0|1\t1|0\t1|1
chr1\t200\t.\tC\tT\t.\tPASS\t.\tGT\t1|1\t1|1\t1|1\t0|1
chr1\t300\t.\tG\tA,T\t.\tPASS\t.\tGT\t0|2\t0/1\t.\t1|2
"""


def _text(pattern):
    out = []
    for p in sorted(glob.glob(pattern, recursive=True)):
        opener = gzip.open if p.endswith(".gz") else open
        with opener(p, "rt") as fh:
            out.append(fh.read())
    return "".join(out)


def test_genotype_workflow_end_to_end(spark, tmpdir_path):
    vcf = write(tmpdir_path / "in" / "chr1.vcf", VCF)
    samples = write(tmpdir_path / "samples.txt", "s3\ns1\n")
    out = str(tmpdir_path / "out")
    WF.extract_genotypes(spark, vcf, samples, out)
    mat = _text(f"{out}/genotype/**/*.csv")
    assert mat.splitlines()[0] == "varID\ts3\ts1"
    assert "1_100_A_G_GRCh38\t1\t0" in mat and "1_300_G_A,T_GRCh38\t.\t." in mat
    ann = _text(f"{out}/variant_annotation/*.csv")
    assert "1_200_C_T_GRCh38\tchr1\t200\tC\tT" in ann
    WF.maf_annotation_job(spark, f"{out}/genotype", f"{out}/variant_annotation", f"{out}/snp")
    snp = _text(f"{out}/snp/**/*.csv")
    lines = snp.splitlines()
    assert lines[0] == "chromosome\tpos\tvarID\tref_vcf\talt_vcf\tR2\tMAF\trsid\trsid_dbSNP150"
    body = {ln.split("\t")[2]: ln for ln in lines if not ln.startswith("chromosome")}
    assert body["1_100_A_G_GRCh38"].split("\t")[6] == "0.25"  # s3=1, s1=0
    assert body["1_300_G_A,T_GRCh38"].split("\t")[6] == "NA"


def test_snp_annotation_text(spark, tmpdir_path):
    df = spark.createDataFrame(
        [("1", 100, "v1", "A", "G", 1.0, 1e-05, ".", "."), ("1", 200, "v2", "C", "T", 1.0, None, ".", ".")],
        "chromosome string, pos long, varID string, ref_vcf string, alt_vcf string, R2 double, "
        "MAF double, rsid string, rsid_dbSNP150 string")
    W.write_snp_annotation(df, str(tmpdir_path / "snp"))
    text = _text(str(tmpdir_path / "snp" / "*.csv"))
    assert "1\t100\tv1\tA\tG\t1.0\t1e-05\t.\t." in text
    assert "1\t200\tv2\tC\tT\t1.0\tNA\t.\t." in text


def test_matrices_and_predictdb_text(spark, tmpdir_path):
    m = spark.createDataFrame([("neurons", "g1", 1.0, float("nan")), ("neurons", "g2", None, 2.0)],
                              "cell_type string, gene_name string, S1 double, S2 double")
    W.write_cell_type_matrices(m, str(tmpdir_path / "m"))
    text = _text(str(tmpdir_path / "m" / "cell_type=neurons" / "*.csv"))
    assert "g1,1.0," in text and "g2,,2.0" in text
    e = m.withColumnRenamed("gene_name", "NAME")
    W.write_predictdb_expression(e, str(tmpdir_path / "p"))
    ptxt = _text(str(tmpdir_path / "p" / "cell_type=neurons" / "*.csv.gz"))
    assert ptxt.splitlines()[0] == "NAME\tS1\tS2"


def test_export_bundle(spark, tmpdir_path):
    ga = spark.createDataFrame([("ENSG1", "A")], "ensembl_id string, gene_name string")
    sa = spark.createDataFrame([("v1",)], "varID string")
    gt = spark.createDataFrame([("v1",), ("v2",)], "varid string")
    ex = spark.createDataFrame([("ENSG1", 1.0), ("ENSG9", 2.0)], "NAME string, S1 double")
    rep = {r.item: r.value for r in W.export_bundle(spark, str(tmpdir_path / "b"), ga, sa, gt, ex)
           .collect()}
    assert rep["genotype_keys_not_in_snp_annotation"] == 1
    assert rep["expression_keys_not_in_gene_annotation"] == 1
    assert rep["snp_annotation_keys_not_in_genotype"] == 0
    assert rep["genotype_rows"] == 2


def test_stream_bin_means_available_now(spark, tmpdir_path):
    land = tmpdir_path / "land"
    t = spark.createDataFrame(
        [("S1", "chr1_1_2", [[1.0, 2.0], [3.0, 4.0]])], REGION_TENSORS)
    t.write.parquet(str(land / "batch1"))
    L.stream_bin_means(spark, str(land / "*"), str(tmpdir_path / "sink"), str(tmpdir_path / "ck"))
    t.withColumn("region", F.lit("chr2_3_4")).write.parquet(str(land / "batch2"))
    L.stream_bin_means(spark, str(land / "*"), str(tmpdir_path / "sink"), str(tmpdir_path / "ck"))
    got = {r.region: r.features for r in spark.read.parquet(str(tmpdir_path / "sink")).collect()}
    assert got == {"chr1_1_2": [2.0, 3.0], "chr2_3_4": [2.0, 3.0]}


def test_run_file_batches(spark, tmpdir_path):
    land = tmpdir_path / "vcf"
    write(land / "chr1.vcf", VCF)
    seen = []
    L.run_file_batches(spark, str(land), str(tmpdir_path / "ck"),
                       lambda s, paths, epoch: seen.append(len(paths)))
    write(land / "chr2.vcf", VCF.replace("chr1", "chr2"))
    L.run_file_batches(spark, str(land), str(tmpdir_path / "ck"),
                       lambda s, paths, epoch: seen.append(len(paths)))
    assert seen == [1, 1]


def test_first_n_per_key_with_hot_key(spark):
    rows = [("hot", i) for i in range(5000)] + [("cold", i) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, o long")
    got = sorted((r.k, r.o, r.rank) for r in C.first_n_per_key(df, ["k"], ["o"], 3).collect())
    assert got == [("cold", 0, 1), ("cold", 1, 2), ("cold", 2, 3),
                   ("hot", 0, 1), ("hot", 1, 2), ("hot", 2, 3)]


def test_keep_first_last_wins(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o long, v string")
    assert {r.k: r.v for r in C.keep_first(df, ["k"], "o").collect()} == {"a": "y", "b": "z"}
    assert {r.k: r.v for r in C.last_wins(df, ["k"], "o").collect()} == {"a": "x", "b": "z"}


def test_stream_vcf_landing(spark, tmpdir_path):
    land = tmpdir_path / "vcf"
    write(land / "chr1.vcf", VCF)
    samples = write(tmpdir_path / "samples.txt", "s4\ns2\n")
    out = str(tmpdir_path / "geno")
    L.stream_vcf_landing(spark, str(land), samples, out, str(tmpdir_path / "ck"))
    write(land / "chr2.vcf", VCF.replace("chr1", "chr2"))
    L.stream_vcf_landing(spark, str(land), samples, out, str(tmpdir_path / "ck"))
    text = _text(f"{out}/epoch=*/genotype/**/*.csv")
    assert "1_100_A_G_GRCh38\t2\t1" in text and "2_100_A_G_GRCh38\t2\t1" in text
    assert text.count("1_100_A_G_GRCh38\t") == 1


def test_feature_csv_exports_round_trip(spark, tmpdir_path):
    from twasprep.sources import tables as S

    regions = spark.createDataFrame(
        [("S1", "chr1_10_20", "chr1", [1.5, float("nan"), 3.0]), ("S1", "chr2_1_2", "chr2", [1.0, 2.0, 3.0])],
        "sample_id string, region string, chromo string, features array<double>")
    W.write_region_features(regions, str(tmpdir_path / "reg"), fmt="csv", width=3)
    text = _text(str(tmpdir_path / "reg" / "sample_id=S1" / "*.csv"))
    assert text.splitlines()[0] == "gene_name,0,1,2,chromo"
    assert "chr1_10_20,1.5,,3.0,chr1" in text
    back = {r.gene_name: r for r in S.read_feature_csv(spark, str(tmpdir_path / "reg")).collect()}
    assert back["chr2_1_2"].features == [1.0, 2.0, 3.0] and back["chr2_1_2"].chromo == "chr2"
    assert back["chr2_1_2"].sample_id == "S1"
    genes = regions.withColumnRenamed("region", "gene_name").drop("chromo")
    W.write_gene_features(genes, str(tmpdir_path / "gen"), fmt="csv", width=3)
    gtext = _text(str(tmpdir_path / "gen" / "sample_id=S1" / "*.csv.gz"))
    assert gtext.splitlines()[0] == "gene_name,0,1,2"
