"""Bucketed tables: equal results, and no exchange of the wide or large side."""

import re

import numpy as np
from pyspark.sql import functions as F

from twasprep.operators import predict as P
from twasprep.operators import rsid as R
from twasprep.plans import bucketed as B
from twasprep.plans import driver_views as V

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rsid_join_without_exchange_and_with_a_pruned_scan(spark, tmpdir_path):
    snps, db = V.snp_annotation_rows(spark, SF), V.dbsnp_rows(spark, SF)
    some = snps.where(F.col("chromosome").isin("1", "2", "10"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup = B.bucket_lookup(db, f"{tmpdir_path}/l", 6)
        df = B.resolve_bucketed(B.bucket_snps(some, f"{tmpdir_path}/s", 6), lookup, with_flag=True)
        plan = _plan(df)
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert re.search(r"PartitionFilters: \[[^\]]*folder[^\]]* IN ", plan)
        rows = lambda d: sorted(map(tuple, d.collect()), key=str)
        assert rows(df) == rows(R.resolve_rsids(some, db, with_flag=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_zscores_without_moving_vectors_at_full_width(spark, tmpdir_path):
    rng = np.random.default_rng(2)
    rows = [(f"S{i % 2}" if i < 40 else "one", f"g{i % 15}" if i < 40 else "g", i, [float(x) for x in rng.normal(size=5313)])
            for i in range(41)]
    rows.append(("S0", None, 50, rows[0][3]))
    feats = spark.createDataFrame(rows, "sample_id string, gene_name string, ord long, features array<double>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = B.bucket_features(feats, f"{tmpdir_path}/f", 4)
        df = P.zscore_bucketed(table, B.SAMPLE_PARTS)
        plan = _plan(df)
        # the only exchanges are the per-sample statistics' (partial sums, then vectors per part)
        inputs = re.findall(r"Exchange hashpartitioning\(([^)]*)\)[^\n]*\n([^\n]*)", plan)
        assert len(inputs) == 2 and all("FileScan" not in below for _, below in inputs), plan
        assert "Exchange" not in _plan(P.first_gene_rows(table))
        got = {(r.sample_id, r.gene_name): r.features for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {(r.sample_id, r.gene_name): r.features for r in P.zscore_features(feats).collect()}
    assert got.keys() == want.keys() and len(got) == 32
    for k in want:
        np.testing.assert_allclose(got[k], want[k], rtol=1e-9)


def test_a_large_sample_is_spread_over_buckets(spark, tmpdir_path):
    feats = spark.range(3000).select(F.lit("S").alias("sample_id"), F.concat(F.lit("g"), "id").alias("gene_name"),
                                     F.col("id").alias("ord"), F.array(F.col("id").cast("double")).alias("features"))
    table = B.bucket_features(feats, f"{tmpdir_path}/f", 8)
    per_file = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert max(per_file) < 1500
