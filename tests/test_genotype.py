from conftest import write

from twasprep.operators import genotype as G
from twasprep.sources import tables as S
from twasprep.sources.text import read_lines, read_sample_list
from twasprep.sources.vcf import read_vcf

VCF = """##fileformat=VCFv4.2
##contig=<ID=chr1>
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\ts3\ts4
chr1\t100\t.\tA\tG\t.\tPASS\t.\tGT\t0|0\t0|1\t1|0\t1|1
chr1\t200\t.\tC\tT\t.\tPASS\t.\tGT:DS\t1|1:2\t1|1:2\t1|1:2\t0|1:1
chr1\t300\t.\tG\tA,T\t.\tPASS\t.\tGT\t0|2\t0/1\t.\t1|2
"""


def _vcf(spark, tmp):
    return read_vcf(spark, write(tmp / "chr1.vcf", VCF))


def test_read_lines_numbers_lines_per_file(spark, tmpdir_path):
    write(tmpdir_path / "a.txt", "x0\nx1\nx2\n")
    write(tmpdir_path / "b.txt", "y0\ny1\n")
    rows = read_lines(spark, str(tmpdir_path)).collect()
    got = sorted((r.file_path.rsplit("/", 1)[1], r.line_no, r.value) for r in rows)
    assert got == [("a.txt", 0, "x0"), ("a.txt", 1, "x1"), ("a.txt", 2, "x2"),
                   ("b.txt", 0, "y0"), ("b.txt", 1, "y1")]


def test_read_lines_many_splits(spark, tmpdir_path):
    n = 20000
    write(tmpdir_path / "big.txt", "".join(f"{i}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        rows = read_lines(spark, str(tmpdir_path / "big.txt"))
        assert rows.rdd.getNumPartitions() >= 1
        bad = rows.where("cast(value as long) != line_no").count()
        assert rows.count() == n and bad == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_extract_dosages_in_sample_list_order(spark, tmpdir_path):
    vcf = _vcf(spark, tmpdir_path)
    samples = read_sample_list(spark, write(tmpdir_path / "samples.txt", "s3\ns1\n"))
    arrays = {r.varid: list(r.dosages) for r in G.extract_dosages(vcf, samples).collect()}
    assert arrays == {"chr1_100_A_G": [1, 0], "chr1_200_C_T": [2, 2], "chr1_300_G_A,T": [None, None]}


def test_extract_all_samples_and_counts(spark, tmpdir_path):
    vcf = _vcf(spark, tmpdir_path)
    samples = spark.createDataFrame([(0, "s1"), (1, "s2"), (2, "s3"), (3, "s4")],
                                    "ord int, sample_id string")
    arrays = G.extract_dosages(vcf, samples)
    got = {r.varid: list(r.dosages) for r in arrays.collect()}
    assert got["chr1_100_A_G"] == [0, 1, 1, 2]
    assert got["chr1_200_C_T"] == [2, 2, 2, 1]
    counts = {r.varid: (r.alt_count, r.total_alleles)
              for r in G.allele_counts_arrays(arrays).collect()}
    assert counts == {"chr1_100_A_G": (4, 8), "chr1_200_C_T": (7, 8), "chr1_300_G_A,T": (0, 0)}
    long = G.dosages_long(arrays, samples)
    counts_long = {r.varid: (r.alt_count, r.total_alleles) for r in G.allele_counts(long).collect()}
    assert counts_long == counts
    maf = {r.varid: r.MAF for r in G.maf_table(G.allele_counts_arrays(arrays)).collect()}
    assert maf == {"chr1_100_A_G": 0.5, "chr1_200_C_T": 0.125, "chr1_300_G_A,T": None}


def test_missing_sample_gives_null_dosages(spark, tmpdir_path):
    vcf = _vcf(spark, tmpdir_path)
    samples = spark.createDataFrame([(0, "s4"), (1, "nobody")], "ord int, sample_id string")
    got = {r.varid: list(r.dosages) for r in G.extract_dosages(vcf, samples).collect()}
    assert got["chr1_100_A_G"] == [2, None]


def test_variant_annotation_and_matrix(spark, tmpdir_path):
    vcf = _vcf(spark, tmpdir_path)
    ann = G.variant_annotation(vcf).orderBy("pos").collect()
    assert [(r.varid, r.chrom, r.pos, r.ref, r.alt) for r in ann] == [
        ("chr1_100_A_G", "chr1", 100, "A", "G"), ("chr1_200_C_T", "chr1", 200, "C", "T"),
        ("chr1_300_G_A,T", "chr1", 300, "G", "A,T")]
    samples = spark.createDataFrame([(0, "s3"), (1, "s1")], "ord int, sample_id string")
    arrays = G.extract_dosages(vcf, samples)
    long = G.dosages_long(arrays, samples)
    wide = G.dosage_matrix(long, samples)
    assert wide.columns == ["varid", "s3", "s1"]
    lines = sorted(r.value for r in G.matrix_lines(arrays).collect())
    assert lines == ["chr1_100_A_G\t1\t0", "chr1_200_C_T\t2\t2", "chr1_300_G_A,T\t.\t."]


def test_dosage_matrix_text_and_annotation_text(spark, tmpdir_path):
    gpath = write(tmpdir_path / "g" / "chr1_genotypes_final.txt",
                  "varID\ts1\ts2\ts3\n1_100_A_G_GRCh38 0 1 2\n1_200_C_T_GRCh38\t.\t2\t2\n\n"
                  "1_100_A_G_GRCh38 2 2 2\n")
    apath = write(tmpdir_path / "a" / "chr1_variant_annotation.txt",
                  "1_100_A_G_GRCh38\tchr1\t100\tA\tG\n1_200_C_T_GRCh38 chr1 200 C T\n"
                  "1_300_G_A_GRCh38\tchr1\t300\tG\tA\nshort\tchr1\t1\tA\n"
                  "1_400_G_A_GRCh38\tchr1\t400\tG\tA\textra\n")
    matrix = S.read_dosage_matrix(spark, gpath)
    assert matrix.headers.first().names == ["s1", "s2", "s3"]
    counts = {r.varid: (r.alt_count, r.total_alleles)
              for r in G.matrix_allele_counts(matrix).collect()}
    # the repeated varID keeps its last row
    assert counts == {"1_100_A_G_GRCh38": (6, 6), "1_200_C_T_GRCh38": (4, 4)}
    ann = S.read_variant_annotation(spark, apath)
    assert ann.count() == 3
    assert S.read_variant_annotation(spark, apath, rejects=True).count() == 1
    snps = {r.varID: r for r in G.annotate_maf(ann, G.maf_table(G.matrix_allele_counts(matrix)))
            .collect()}
    assert snps["1_100_A_G_GRCh38"].MAF == 0.0
    assert snps["1_200_C_T_GRCh38"].MAF == 0.0
    assert snps["1_300_G_A_GRCh38"].MAF is None
    r = snps["1_100_A_G_GRCh38"]
    assert (r.chromosome, r.pos, r.R2, r.rsid, r.rsid_dbSNP150) == ("1", 100, 1.0, ".", ".")


def test_filter_chromosomes(spark):
    df = spark.createDataFrame([(c,) for c in ["1", "2", "10", "X"]], "chromosome string")
    assert G.filter_chromosomes(df, "all").count() == 4
    assert sorted(r.chromosome for r in G.filter_chromosomes(df, "1,X").collect()) == ["1", "X"]


def test_order_numbering_follows_file_order_across_splits(spark, tmpdir_path):
    from pyspark.sql import functions as F

    n = 20000
    write(tmpdir_path / "big.txt", "".join(f"{i}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        rows = read_lines(spark, str(tmpdir_path / "big.txt"), numbering="order")
        first = rows.agg(F.min_by("value", "line_no").alias("v"),
                         F.max_by("value", "line_no").alias("w")).first()
        assert (first.v, first.w) == ("0", str(n - 1))
        ranked = rows.select(F.col("value").cast("long").alias("v"), "line_no") \
            .orderBy("line_no").collect()
        assert [r.v for r in ranked] == list(range(n))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_snp_annotation_from_any_layout(spark, tmpdir_path):
    vcf = _vcf(spark, tmpdir_path)
    samples = spark.createDataFrame([(0, "s1"), (1, "s2"), (2, "s3"), (3, "s4")],
                                    "ord int, sample_id string")
    arrays = G.extract_dosages(vcf, samples)
    ann = G.variant_annotation(vcf)
    a = {r.varID: r.MAF for r in G.snp_annotation_from_genotypes(arrays, ann).collect()}
    b = {r.varID: r.MAF for r in G.snp_annotation_from_genotypes(
        G.dosages_long(arrays, samples), ann, "1").collect()}
    assert a == {"chr1_100_A_G": 0.5, "chr1_200_C_T": 0.125, "chr1_300_G_A,T": None}
    assert b == a


def test_single_pass_annotation_matches_join_path(spark, tmpdir_path):
    vcf = _vcf(spark, tmpdir_path)
    samples = spark.createDataFrame([(0, "s1"), (1, "s2"), (2, "s4")], "ord int, sample_id string")
    arrays = G.extract_dosages(vcf, samples)
    single = {tuple(r) for r in G.snp_annotation_single_pass(arrays).collect()}
    joined = {tuple(r) for r in G.snp_annotation_from_genotypes(
        arrays, G.variant_annotation(vcf)).collect()}
    assert single == joined
    plan = G.snp_annotation_single_pass(arrays)._jdf.queryExecution().executedPlan().toString()
    # variant rows are never shuffled: no join by key, no aggregation by variant;
    # the only exchange feeds the broadcast per-file sample positions
    assert "SortMergeJoin" not in plan and "keys=[varid" not in plan
    assert "BroadcastHashJoin" in plan
    # a repeated variant id falls back to the last-wins path
    dup_vcf = VCF + "chr1\t100\t.\tA\tG\t.\tPASS\t.\tGT\t1|1\t1|1\t1|1\t1|1\n"
    from twasprep.sources.vcf import read_vcf as rv
    arrays2 = G.extract_dosages(rv(spark, write(tmpdir_path / "dup" / "chr1.vcf", dup_vcf)),
                                samples)
    rows = [r for r in G.snp_annotation_from_vcf_arrays(arrays2).collect()
            if r.varID == "chr1_100_A_G"]
    assert len(rows) == 2 and {r.MAF for r in rows} == {0.0}
