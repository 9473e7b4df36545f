from conftest import write

from twasprep.operators import rsid as R
from twasprep.sources import tables as S

SNPS = [
    ("1", 100, "1_100_A_G", "A", "G", ".", "."),
    ("1", 200, "1_200_C_T", "C", "T", ".", "."),
    ("1", 300, "1_300_G_A,T", "G", "A,T", ".", "."),
    ("1", 400, "1_400_G_A", "G", "A", "rs9", "."),
    ("1", 500, "1_500_T_C", "T", "C", ".", "rs150"),
    ("1", 600, "1_600_T_C", "T", "C", None, "."),
    ("1", None, "1_x_T_C", "T", "C", ".", "."),
]
DBSNP = [
    ("1", 100, "rs1", "A", "G", 1), ("1", 100, "rs2", "A", "C,G", 2),
    ("1", 200, "rs3", "C", "A", 3), ("chr1", 200, "rs4", "C", "A,T", 4),
    ("1", 300, "rs5", "G", "A,T", 5), ("1", 400, "rs6", "G", "A", 6),
]


def _frames(spark):
    snps = spark.createDataFrame(
        SNPS, "chromosome string, pos long, varID string, ref_vcf string, alt_vcf string, "
              "rsid string, rsid_dbSNP150 string")
    db = spark.createDataFrame(DBSNP, "chrom string, pos long, rsid string, ref string, "
                                      "alt string, ord long")
    return snps, db


def _by_var(df):
    return {r.varID: (r.rsid, r.rsid_dbSNP150) for r in df.collect()}


def test_strict_naming_fallback(spark):
    snps, db = _frames(spark)
    got = _by_var(R.resolve_rsids(snps, db))
    assert got["1_100_A_G"] == ("rs1", "rs1")          # first of two matches
    assert got["1_200_C_T"] == (".", ".")              # bare name has a record at 200
    assert got["1_300_G_A,T"] == ("rs5", "rs5")        # raw list equal
    assert got["1_400_G_A"] == ("rs9", ".")            # already set
    assert got["1_500_T_C"] == (".", "rs150")
    assert got["1_600_T_C"] == (None, ".")              # NULL rsid untouched
    assert got["1_x_T_C"] == (".", ".")                 # no position: kept, not resolved
    assert R.resolve_rsids(snps, db).count() == len(SNPS)


def test_normalized_naming(spark):
    snps, db = _frames(spark)
    got = _by_var(R.resolve_rsids(snps, db, naming="normalized"))
    assert got["1_200_C_T"] == ("rs4", "rs4")           # inside the ALT list of chr1:200


def test_legacy_fill(spark):
    snps, db = _frames(spark)
    got = _by_var(R.resolve_rsids(snps, db, legacy_fill=True))
    assert got["1_500_T_C"] == ("rs150", "rs150")
    assert got["1_100_A_G"] == ("rs1", ".")             # legacy mode leaves rsid_dbSNP150


def test_resolve_is_idempotent(spark):
    snps, db = _frames(spark)
    once = R.resolve_rsids(snps, db)
    twice = R.resolve_rsids(once, db)
    assert _by_var(once) == _by_var(twice)


def test_missing_rsid_column_is_added(spark):
    snps, db = _frames(spark)
    got = _by_var(R.resolve_rsids(snps.drop("rsid"), db))
    assert got["1_400_G_A"] == ("rs6", "rs6")


def test_overlapping_record_blocks_fallback(spark):
    snps = spark.createDataFrame([("2", 12, "2_12_A_C", "A", "C", ".", ".")],
                                 "chromosome string, pos long, varID string, ref_vcf string, "
                                 "alt_vcf string, rsid string, rsid_dbSNP150 string")
    db = spark.createDataFrame([("2", 10, "rsdel", "ACGT", "A", 1),
                                ("chr2", 12, "rsok", "A", "C", 2)],
                               "chrom string, pos long, rsid string, ref string, alt string, ord long")
    assert _by_var(R.resolve_rsids(snps, db))["2_12_A_C"] == (".", ".")
    assert _by_var(R.resolve_rsids(snps, db, naming="normalized"))["2_12_A_C"][0] == "rsok"


def test_stats_and_naming_report(spark):
    snps, db = _frames(spark)
    stats = R.rsid_stats(R.resolve_rsids(snps, db, with_flag=True)).collect()
    assert [(r.chromosome, r.total, r.found) for r in stats] == [("1", 7, 2)]
    assert abs(stats[0].pct - round(200 / 7, 6)) < 1e-12
    rep = {r.varID: r for r in R.rsid_naming_report(snps, db).collect()}
    assert (rep["1_100_A_G"].bare_hits, rep["1_100_A_G"].chr_hits) == (2, 0)
    assert rep["1_100_A_G"].first_hits == "rs1,rs2"
    assert (rep["1_200_C_T"].bare_hits, rep["1_200_C_T"].chr_hits) == (1, 1)
    assert rep["1_200_C_T"].used_naming == "bare"
    assert rep["1_500_T_C"].used_naming is None and rep["1_500_T_C"].bare_hits == 0


def test_dbsnp_vcf_reader(spark, tmpdir_path):
    path = write(tmpdir_path / "dbsnp.vcf",
                 "##fileformat=VCFv4.0\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\n"
                 "1\t100\trs1\tA\tG\t.\n1\tbad\trsX\tA\tG\t.\n1\t100\trs2\tA\tC,G\t.\n"
                 "1\t5\trs3\n")
    db = S.read_dbsnp_vcf(spark, path).orderBy("ord").collect()
    assert [(r.chrom, r.pos, r.rsid, r.alt) for r in db] == [("1", 100, "rs1", "G"),
                                                              ("1", 100, "rs2", "C,G")]
    assert db[0].ord < db[1].ord


def test_snp_annotation_reader(spark, tmpdir_path):
    path = write(tmpdir_path / "chr1_annotation.txt",
                 "chromosome\tpos\tvarID\tref_vcf\talt_vcf\tR2\tMAF\trsid\trsid_dbSNP150\n"
                 "1\t100\t1_100_A_G\tA\tG\t1.0\t0.5\t.\t.\n"
                 "1\t300\t1_300_G_T\tG\tT\t1.0\tNA\t.\t.\n"
                 "1\t400\t1_400_G_T\tG\tT\t1.0\t\t.\t.\n")
    rows = S.read_snp_annotation(spark, path).orderBy("pos").collect()
    assert [r.MAF for r in rows] == [0.5, None, None]
    assert rows[0].R2 == 1.0 and rows[0].rsid == "."


def test_naming_report_sample_size(spark):
    snps, db = _frames(spark)
    rep = R.rsid_naming_report(snps, db, sample_size=2, order_col="varID")
    assert sorted(r.varID for r in rep.collect()) == ["1_100_A_G", "1_200_C_T"]


def test_lookup_chromosome_of_file(spark, tmpdir_path):
    path = write(tmpdir_path / "chr1_annotation.txt",
                 "chromosome\tpos\tvarID\tref_vcf\talt_vcf\tR2\tMAF\trsid\trsid_dbSNP150\n"
                 "1\t100\t1_100_A_G\tA\tG\t1.0\t0.5\t.\t.\n"
                 "2\t500\t2_500_T_C\tT\tC\t1.0\t0.5\t.\t.\n")
    db = spark.createDataFrame([("1", 100, "rs1", "A", "G", 1), ("2", 500, "rs2", "T", "C", 2)],
                               "chrom string, pos long, rsid string, ref string, alt string, ord long")
    snps = S.read_snp_annotation(spark, path, with_file=True)
    by_row = _by_var(R.resolve_rsids(snps, db))
    by_file = _by_var(R.resolve_rsids(snps, db, lookup_chromosome="file"))
    assert by_row["2_500_T_C"][0] == "rs2"
    assert by_file["2_500_T_C"][0] == "."          # looked up under chromosome 1
    assert by_file["1_100_A_G"][0] == "rs1"
    assert "file_path" not in R.resolve_rsids(snps, db, lookup_chromosome="file").columns
