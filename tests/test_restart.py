"""Jobs by key: finished keys are skipped, a bad one fails alone and can be retried."""

import glob
import os

from conftest import write
from pyspark.sql import functions as F

from twasprep import cli
from twasprep.plans import keyed_jobs as KJ
from twasprep.plans import restart as RS
from twasprep.schemas import REGION_TENSORS

HEADER = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\n"


def _status(spark, path):
    return sorted((r.key, r.status, r.rows) for r in RS.read_attempts(spark, path).collect())


def _files(path):
    return {p: os.path.getmtime(p) for p in glob.glob(f"{path}/**/part-*", recursive=True)}


def test_one_bad_key_of_many_costs_a_few_jobs(spark, tmpdir_path):
    keys = spark.range(64).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    calls, bad = [], {"k5", "k40"}

    def work(batch):
        names = {r.key for r in batch.collect()}
        calls.append(len(names))
        if names & bad:
            raise ValueError(f"cannot read {sorted(names & bad)[0]}\nmore")
        return batch.withColumn("rows", F.lit(2))

    path = str(tmpdir_path / "m")
    summary = {r.status: (r.inputs, r.rows) for r in RS.run_keys(keys, "s", path, work).collect()}
    assert summary == {"success": (62, 124), "failed": (2, 0)} and len(calls) < 30
    failed = {r.key: r.detail for r in RS.read_attempts(spark, path).where("status = 'failed'").collect()}
    assert failed == {"k5": "cannot read k5", "k40": "cannot read k40"}
    calls.clear()
    bad.clear()
    summary = {r.status: r.inputs for r in RS.run_keys(keys, "s", path, work).collect()}
    assert summary == {"success": 64} and calls == [2]      # only the failed keys run again
    RS.run_keys(keys, "s", path, work)
    assert calls == [2]                                     # nothing is pending


def test_extract_goes_past_a_bad_file_and_repairs_it(spark, tmpdir_path):
    d = tmpdir_path
    write(d / "vcf" / "chr1.vcf", HEADER + "chr1\t100\t.\tA\tG\t.\t.\t.\tGT\t0|1\t1|1\n")
    (d / "vcf" / "chr2.vcf.gz").write_bytes(b"\x1f\x8b broken")
    samples = write(d / "samples.txt", "s1\ns2\n")
    out = str(d / "out")
    argv = ["extract", "--vcf", str(d / "vcf"), "--samples", samples, "--output-dir", out]
    cli.run(spark, cli.parse(argv))
    assert _status(spark, out + ".manifest") == [("chr1", "success", 1), ("chr2", "failed", 0)]
    before = _files(out)
    import gzip
    with gzip.open(d / "vcf" / "chr2.vcf.gz", "wt") as f:
        f.write(HEADER + "chr2\t7\t.\tC\tT\t.\t.\t.\tGT\t0|0\t0|1\nchr2\t9\t.\tC\tT\t.\t.\t.\tGT\t0|0\t0|1\n")
    cli.run(spark, cli.parse(argv))
    assert _status(spark, out + ".manifest")[2:] == [("chr2", "success", 2)]
    after = _files(out)
    assert before.items() <= after.items() and len(after) > len(before)   # chr1 was not written again
    cli.run(spark, cli.parse(["maf", "--genotype-dir", f"{out}/genotype", "--annotation-dir",
                              f"{out}/variant_annotation", "--output-dir", f"{out}-snp"]))
    assert _status(spark, f"{out}-snp.manifest") == [("1", "success", 1), ("2", "success", 2)]
    text = "".join(open(p).read() for p in glob.glob(f"{out}-snp/**/*.csv", recursive=True))
    assert "1\t100\t1_100_A_G_GRCh38\tA\tG\t1.0\t0.25\t.\t." in text and "2_9_C_T_GRCh38" in text


def test_rsid_fails_one_annotation_file_alone(spark, tmpdir_path):
    d = tmpdir_path
    head = "chromosome\tpos\tvarID\tref_vcf\talt_vcf\tR2\tMAF\trsid\trsid_dbSNP150\n"
    write(d / "ann" / "chr1_annotation.txt", head + "1\t100\t1_100_A_G\tA\tG\t1.0\t0.5\t.\t.\n")
    write(d / "ann" / "chr2_annotation.txt", "no header here\n")
    write(d / "ann" / "chr3_annotation.txt", head + "3\t5\t3_5_A_G\tA\tG\t1.0\t0.5\t.\t.\n")
    db = write(d / "dbsnp.vcf", "##x\n#CHROM\tPOS\tID\tREF\tALT\n1\t100\trs7\tA\tG\n3\t5\trs9\tA\tG\n")
    summary, stats = KJ.rsid_by_file(spark, str(d / "ann"), db, str(d / "out"), str(d / "m"))
    assert {r.status: r.inputs for r in summary.collect()} == {"success": 2, "failed": 1}
    assert {(r.chromosome, r.found) for r in stats.collect()} == {("1", 1), ("3", 1)}
    write(d / "ann" / "chr2_annotation.txt", head + "2\t5\t2_5_A_G\tA\tG\t1.0\t0.5\t.\t.\n")
    summary, stats = KJ.rsid_by_file(spark, str(d / "ann"), db, str(d / "out"), str(d / "m"))
    assert {r.status: r.inputs for r in summary.collect()} == {"success": 3}
    text = "".join(open(p).read() for p in glob.glob(f"{d}/out/with_rsids/**/*.csv", recursive=True))
    assert "rs7\trs7" in text and "rs9\trs9" in text and "2\t5\t2_5_A_G\tA\tG\t1.0\t0.5\t.\t." in text


def test_landed_dbsnp_is_read_for_the_files_chromosomes_only(spark, tmpdir_path):
    from twasprep.plans import workflows as WF

    db = write(tmpdir_path / "d.vcf", "#CHROM\tPOS\tID\tREF\tALT\n1\t5\trs1\tA\tG\nchr1\t6\trs2\tA\tG\n"
                                      "2\t5\trs3\tA\tG\nchr11\t5\trs4\tA\tG\n")
    WF.land_dbsnp(spark, db, str(tmpdir_path / "pq"))
    snps = spark.createDataFrame([("chr1", 5), (None, 1)], "chromosome string, pos long")
    kept = WF.of_chromosomes_in(WF.read_landed_dbsnp(spark, str(tmpdir_path / "pq")), snps)
    assert sorted(r.rsid for r in kept.collect()) == ["rs1", "rs2"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cast(chrom" in plan or "PartitionFilters: [chrom" in plan


def test_gene_features_of_one_broken_sample_fail_alone(spark, tmpdir_path):
    d = tmpdir_path
    rows = [(s, f"chr1_{r}", [[float(r)], [float(r) + 1]]) for s in ("007", "a b", "c") for r in range(3)]
    spark.createDataFrame(rows, REGION_TENSORS).write.partitionBy("sample_id").parquet(str(d / "t"))
    broken = glob.glob(f"{d}/t/sample_id=c/*.parquet")
    whole = {p: open(p, "rb").read() for p in broken}
    for p in broken:
        open(p, "wb").write(b"PAR1 not parquet PAR1")
    windows = write(d / "w.csv", "gene_name,region_names\nGA,chr1_0|chr1_2\n")
    run = lambda: {r.status: r.inputs for r in KJ.gene_features_by_sample(
        spark, str(d / "t"), windows, str(d / "o"), str(d / "m")).collect()}
    assert run() == {"success": 2, "failed": 1}
    got = {r.sample_id: r.features for r in spark.read.schema(
        "gene_name string, features array<double>, sample_id string").parquet(str(d / "o" / "gene_features")).collect()}
    assert got == {"007": [1.5], "a b": [1.5]}
    for p, data in whole.items():
        open(p, "wb").write(data)
    assert run() == {"success": 3}


def test_chunked_features_of_a_second_run_leave_the_first_alone(spark, tmpdir_path):
    d = tmpdir_path
    rows = lambda s: [(s, f"chr1_{r}", [[float(r)], [float(r)]]) for r in range(6)]
    spark.createDataFrame(rows("A"), REGION_TENSORS).write.partitionBy("sample_id").parquet(str(d / "t"))
    windows = write(d / "w.csv", "gene_name,region_names\nGA,chr1_0|chr1_5\n")
    run = lambda: KJ.gene_features_by_sample(spark, str(d / "t"), windows, str(d / "o"), str(d / "m"),
                                             chunk_rows=6)
    run()
    before = _files(f"{d}/o")
    spark.createDataFrame(rows("B"), REGION_TENSORS).write.mode("append").partitionBy("sample_id").parquet(str(d / "t"))
    run()
    after = _files(f"{d}/o")
    assert before.items() <= after.items() and len(after) == 2 * len(before)
