"""Invariants over generated inputs."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from twasprep.functions.genotype import dosage_of_gt, folded_maf
from twasprep.operators import expression as X
from twasprep.operators import predict as P


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5000), st.integers(1, 5000)), min_size=1, max_size=200))
def test_maf_in_range_and_python_rounding(spark, pairs):
    rows = [(min(k, 2 * d), 2 * d) for k, d in pairs]
    df = spark.createDataFrame(rows, "k long, d long")
    got = [(r.k, r.d, r.m) for r in df.select("k", "d", folded_maf("k", "d").alias("m")).collect()]
    for k, d, m in got:
        x = k / d
        x = 1 - x if x > 0.5 else x
        assert 0.0 <= m <= 0.5
        assert m == round(x, 5)


def test_dosage_domain(spark):
    gts = ["0|0", "0|1", "1|0", "1|1", "0/0", "2|1", ".|.", "0", "", None, "1|1|1"]
    df = spark.createDataFrame([(g,) for g in gts], "gt string")
    vals = {r.d for r in df.select(dosage_of_gt("gt").alias("d")).collect()}
    assert vals <= {0, 1, 2, None}


def test_pivot_unpivot_identity(spark):
    rng = np.random.default_rng(7)
    samples = ["S0", "S1", "S2"]
    rows = [(ct, f"g{g}", s, float(rng.normal()))
            for ct in ("a", "b") for g in range(20) for s in samples if rng.random() > 0.2]
    long = spark.createDataFrame(rows, "cell_type string, gene_name string, sample_id string, "
                                       "prediction double")
    wide = X.cell_type_matrix(long, samples)
    back = (wide.unpivot(["cell_type", "gene_name"], samples, "sample_id", "prediction")
            .where(F.col("prediction").isNotNull()))
    assert sorted(map(tuple, back.select("cell_type", "gene_name", "sample_id", "prediction")
                      .collect())) == sorted(rows)


def test_zscore_moments(spark):
    rng = np.random.default_rng(3)
    rows = [("S", f"g{i}", i, [float(v) for v in rng.normal(5.0, 2.0, size=6)]) for i in range(50)]
    f = spark.createDataFrame(rows, "sample_id string, gene_name string, ord long, "
                                    "features array<double>")
    z = np.array([r.features for r in P.zscore_features(f).collect()])
    assert np.allclose(z.mean(axis=0), 0.0, atol=1e-9)
    assert np.allclose(z.std(axis=0, ddof=1), 1.0, atol=1e-6)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20000), st.integers(1, 20000)), min_size=1, max_size=200))
def test_maf_text_like_python(spark, pairs):
    from twasprep.functions.genotype import render_maf

    rows = [(min(k, 2 * d), 2 * d) for k, d in pairs]
    df = spark.createDataFrame(rows, "k long, d long")
    got = df.select("k", "d", render_maf(folded_maf("k", "d")).alias("t")).collect()
    for r in got:
        x = r.k / r.d
        x = 1 - x if x > 0.5 else x
        assert r.t == str(round(x, 5)), (r.k, r.d)


def test_gzip_text_line_numbers(spark, tmpdir_path):
    import gzip

    from twasprep.sources.text import read_lines

    path = tmpdir_path / "x.txt.gz"
    with gzip.open(path, "wt") as fh:
        fh.write("".join(f"{i}\n" for i in range(5000)))
    rows = read_lines(spark, str(path))
    assert rows.where("cast(value as long) != line_no").count() == 0 and rows.count() == 5000
