"""Inputs that once lost or changed rows without a word."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import write
from twasprep.operators import predict as P
from twasprep.operators import validate as VA
from twasprep.plans import workflows as WF
from twasprep.sinks import writers as W
from twasprep.sources import tables as S

FEATS = "sample_id string, gene_name string, features array<double>"


def test_sampled_checks_look_at_every_group_and_count_all_rows(spark):
    rows = [(c, f"g{i}", "x" if c == "b" and i == 2 else "1.0") for c in "abc" for i in range(20)]
    df = spark.createDataFrame(rows, "cell_type string, gene_name string, s1 string")
    got = {r["cell_type"]: r for r in VA.validate_matrix(
        df, group_by=["cell_type"], sample_rows=5, order_col="gene_name").collect()}
    assert {k: r["n_genes"] for k, r in got.items()} == {"a": 20, "b": 20, "c": 20}
    one = VA.validate_matrix(df.drop("cell_type"), sample_rows=5).collect()
    assert len(one) == 1 and one[0]["n_genes"] == 60


def test_activation_is_kept_and_widths_are_checked(spark):
    f = spark.createDataFrame([("s", "g", [1.0, 1.0])], FEATS)
    layers = {"B": [(np.array([[1.0, 1.0]]), np.array([0.0]))]}
    scored = P.predict_expression(f, P.DenseStackScorer(layers, "sigmoid")).first()
    assert scored["prediction"] == pytest.approx(1 / (1 + np.exp(-2)))
    linear = P.DenseStackScorer(layers)
    assert P.predict_expression(f, linear, "native").first()["prediction"] == 2.0
    short = spark.createDataFrame([("s", "g", [1.0])], FEATS)
    for engine in ("auto", "native"):
        with pytest.raises(Exception):
            P.predict_expression(short, linear, engine).collect()


def test_models_with_two_output_units_are_refused():
    with pytest.raises(ValueError):
        P.DenseStackScorer({"B": [(np.ones((2, 3)), np.zeros(2))]})


def test_tabs_at_the_edges_keep_annotation_rows(spark, tmpdir_path):
    p = write(tmpdir_path / "a.txt", "v1\tchr1\t1\tA\tC\n\tv2\tchr1\t2\tA\tC\nv3\tchr1\t3\tA\tC\t\n")
    assert {r["varid"] for r in S.read_variant_annotation(spark, p).collect()} == {"v1", "v2", "v3"}


def test_sample_names_with_dots_and_blanks_stay_apart(spark, tmpdir_path):
    for name in ("NA1.a", "NA1.b", "HG 1", "x+y"):
        write(tmpdir_path / "in" / f"{name}.csv", "gene_name,B\ng,1.0\n")
    heads = S.read_predictions_csv(spark, str(tmpdir_path / "in")).headers
    assert {r["sample_id"] for r in heads.collect()} == {"NA1.a", "NA1.b", "HG 1", "x+y"}


def test_r2_is_passed_through(spark):
    df = spark.createDataFrame([(0.873, 0.1), (1.0, 0.1), (None, 0.1)], "R2 double, MAF double")
    for c in ("chromosome", "pos", "varID", "ref_vcf", "alt_vcf", "rsid", "rsid_dbSNP150"):
        df = df.withColumn(c, F.lit("1"))
    got = {r["R2"] for r in df.select(*W.snp_annotation_columns(df)).collect()}
    assert got == {"0.873", "1.0", "NA"}


def test_numeric_looking_samples_stay_text_and_chunks_restart_per_sample(spark, tmpdir_path):
    rows = [(s, f"chr1_{i}_{i + 1}", [[float(i)]] * 4) for s in ("007", "008") for i in range(10)]
    spark.createDataFrame(rows, "sample_id string, region string, bins array<array<float>>") \
        .coalesce(1).write.parquet(str(tmpdir_path / "t"))
    windows = "\n".join(["gene_name,region_names", "G1,chr1_0_1|chr1_1_2", "G2,chr1_8_9|chr1_9_10", ""])
    w = write(tmpdir_path / "w.csv", windows)
    out = str(tmpdir_path / "o")
    WF.gene_features_job(spark, str(tmpdir_path / "t"), w, out, chunk_rows=7)
    feats = spark.read.parquet(f"{out}/region_features")
    assert feats.groupBy("ord").count().where("count <> 2").count() == 0
    dirs = {p.name for p in (tmpdir_path / "o" / "region_features").glob("sample_id=*")}
    assert dirs == {"sample_id=007", "sample_id=008"}
    assert "007" in str(sorted(p.name for p in (tmpdir_path / "o" / "gene_features").rglob("*")))
