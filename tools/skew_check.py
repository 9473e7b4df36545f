"""Measure how the grouping operators distribute a hot key.

One key gets a third of all rows of ``events`` (and of a derived feature
table); each operator runs with Spark's event log written to a scratch
folder, and the largest number of records any single task read from a
shuffle is reported next to the size of the hot key.

usage: python tools/skew_check.py sf_dir > docs/SKEW.md
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from twasprep.operators import common as C  # noqa: E402
from twasprep.operators import expression as X  # noqa: E402
from twasprep.operators import genotype as G  # noqa: E402
from twasprep.operators import features as FT  # noqa: E402
from twasprep.operators import predict as P  # noqa: E402
from twasprep.operators import rsid as R  # noqa: E402
from twasprep.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1].rstrip("/")
    log_dir = tempfile.mkdtemp(prefix="twasprep-eventlog-")
    spark = build_session("local[8]", shuffle_partitions=8, extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        # shrink AQE's skew thresholds to this data size (defaults: 256 MB and
        # 5x the median) and force shuffle joins, so the skew-join path runs
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1"})
    # many map tasks, as a large input has (AQE splits a skewed partition
    # along map-output boundaries)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").repartition(32)
    hot = F.when(F.col("event_id") % 3 == 0, F.lit("HOT")).otherwise(
        F.concat(F.lit("g"), F.col("user_id").cast("string")))
    rows = ev.select(F.col("event_type").alias("sample_id"), hot.alias("gene_name"),
                     F.col("event_id").alias("ord"), "value")
    n_rows = rows.count()
    n_hot = rows.where(F.col("gene_name") == "HOT").count()
    one_sample = rows.withColumn("sample_id", F.lit("S"))
    feats = one_sample.select("sample_id", "gene_name", "ord",
                              F.array("value", F.col("value") * 2).alias("features"))
    windows = spark.createDataFrame([("GENE", "HOT|g1|g2")], "gene_name string, region_names string")
    regions = feats.select("sample_id", F.col("gene_name").alias("region"), "ord", "features")
    # a third of the variants share one (chromosome, pos, ref, alt) key; the
    # others are spread over many positions
    variants = rows.select(F.lit("1").alias("chromosome"),
                           F.when(F.col("gene_name") == "HOT", F.lit(100))
                           .otherwise(F.col("ord")).cast("long").alias("pos"),
                           F.concat(F.lit("v"), F.col("ord").cast("string")).alias("varID"),
                           F.lit("A").alias("ref_vcf"),
                           F.when(F.col("gene_name") == "HOT", F.lit("G")).otherwise(F.lit("T"))
                           .alias("alt_vcf"),
                           F.lit(".").alias("rsid"), F.lit(".").alias("rsid_dbSNP150"),
                           # a per-row payload: hot-key rows are not identical in
                           # practice (AQE sizes partitions by compressed bytes)
                           F.sha2(F.col("ord").cast("string"), 256).alias("payload"))
    dbsnp = spark.createDataFrame([("1", 100, "rs1", "A", "G", 1)],
                                  "chrom string, pos long, rsid string, ref string, alt string, ord long")
    long = one_sample.select(F.lit("ct").alias("cell_type"), "gene_name", "sample_id",
                             F.col("value").alias("prediction"), "ord")
    # annotation: a third of the rows carry one varid (positions differ, as
    # the rows of a real hot key would)
    annotation = rows.select(
        F.when(F.col("gene_name") == "HOT", F.lit("vHOT"))
        .otherwise(F.concat(F.lit("v"), F.col("ord").cast("string"))).alias("varid"),
        F.lit("chr1").alias("chrom"), F.col("ord").alias("pos"), F.lit("A").alias("ref"),
        F.lit("G").alias("alt"))
    maf = annotation.select("varid").distinct().withColumn("MAF", F.lit(0.1))
    ops = {
        "keep_first (W1)": lambda: P.keep_first_gene(one_sample),
        "last_wins (A7)": lambda: C.last_wins(one_sample, ["sample_id", "gene_name"], "ord"),
        "first_n_per_key (W3), n=3": lambda: C.first_n_per_key(one_sample, ["gene_name"], ["ord"], 3),
        "duplicate_report (A9)": lambda: P.duplicate_report(one_sample),
        "feature_stats (A6), one sample": lambda: P.feature_stats(feats),
        "gene_region_means (A4)": lambda: FT.gene_region_means(windows, regions),
        "resolve_rsids (J2), hot key": lambda: R.resolve_rsids(variants, dbsnp),
        "annotate_maf (J1), hot varid": lambda: G.annotate_maf(annotation, maf),
        "cell_type_matrix (R2)": lambda: X.cell_type_matrix(long.drop("ord"), ["S"], order_col=None),
    }
    results = []
    for name, build in ops.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
        results.append(name)
    spark.stop()
    # parse the event log: per job group, the largest shuffle read of one task
    group_of_stage, worst = {}, {}
    log = sorted(glob.glob(f"{log_dir}/*"))[-1]
    files = sorted(glob.glob(f"{log}/events_*")) if Path(log).is_dir() else [log]
    lines = []
    for f in files:
        with open(f) as fh:
            lines.extend(fh)
    if True:
        for line in lines:
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    group_of_stage[sid] = g
            elif kind == "SparkListenerTaskEnd":
                g = group_of_stage.get(e.get("Stage ID"))
                m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                recs = m.get("Total Records Read", 0)
                if g is not None:
                    worst[g] = max(worst.get(g, 0), recs)
    print("# Hot-key check\n")
    print("Generated by `tools/skew_check.py`. AQE skew thresholds are lowered to "
          "this data size and broadcast joins are off, so that the shuffle paths a "
          "cluster would take at scale are the ones measured.\n")
    print(f"`events` at `{sf_dir}`: {n_rows} rows, one key holds {n_hot} of them "
          f"({n_hot / n_rows:.0%}). Largest number of shuffled records read by any "
          "single task per operator (event log, local[8], 8 shuffle partitions):\n")
    print("| operator | max records in one task | share of all rows |")
    print("|---|---|---|")
    for name in results:
        w = worst.get(name, 0)
        print(f"| {name} | {w} | {w / n_rows:.2%} |")


if __name__ == "__main__":
    main()
