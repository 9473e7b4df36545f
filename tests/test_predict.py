import math

import numpy as np

from twasprep.operators import predict as P


def _features(spark):
    rows = [
        ("A", "g1", 0, [1.0, 5.0, 2.0]),
        ("A", "g2", 1, [3.0, 5.0, 4.0]),
        ("A", "g1", 2, [100.0, 100.0, 100.0]),   # duplicate gene: dropped (keep first)
        ("A", "g3", 3, [5.0, 5.0, 9.0]),
        ("B", "g1", 0, [7.0, 8.0, 9.0]),         # one-gene sample: std undefined
    ]
    return spark.createDataFrame(rows, "sample_id string, gene_name string, ord long, "
                                       "features array<double>")


def test_keep_first_and_duplicates(spark):
    f = _features(spark)
    kept = {(r.sample_id, r.gene_name): r.ord for r in P.keep_first_gene(f).collect()}
    assert kept[("A", "g1")] == 0 and len(kept) == 4
    dups = [(r.sample_id, r.gene_name, r.n_rows) for r in P.duplicate_report(f).collect()]
    assert dups == [("A", "g1", 2)]


def test_zscore_per_sample(spark):
    z = {(r.sample_id, r.gene_name): r.features for r in P.zscore_features(_features(spark)).collect()}
    x = np.array([[1.0, 5.0, 2.0], [3.0, 5.0, 4.0], [5.0, 5.0, 9.0]])
    expect = (x - x.mean(0)) / (x.std(0, ddof=1) + 1e-8)
    for i, g in enumerate(["g1", "g2", "g3"]):
        assert np.allclose(z[("A", g)], expect[i], atol=1e-12)
    assert z[("A", "g1")][1] == 0.0                  # constant feature -> 0
    assert all(math.isnan(v) for v in z[("B", "g1")])  # single gene -> NaN


def test_dense_scorer_two_layers_and_predictions(spark):
    rng = np.random.default_rng(0)
    w1, b1 = rng.normal(size=(4, 3)), rng.normal(size=4)
    w2, b2 = rng.normal(size=(1, 4)), rng.normal(size=1)
    wl, bl = rng.normal(size=(1, 3)), rng.normal(size=1)
    scorer = P.DenseStackScorer({"neurons": [(w1, b1), (w2, b2)], "opc": [(wl, bl)]})
    feats = spark.createDataFrame([("S", "g1", [1.0, 2.0, 3.0]), ("S", "g2", [0.5, -1.0, 2.0])],
                                  "sample_id string, gene_name string, features array<double>")
    got = {(r.gene_name, r.cell_type): r.prediction
           for r in P.predict_expression(feats, scorer).collect()}
    for g, x in [("g1", np.array([1.0, 2.0, 3.0])), ("g2", np.array([0.5, -1.0, 2.0]))]:
        h = np.maximum(w1 @ x + b1, 0)
        assert abs(got[(g, "neurons")] - float((w2 @ h + b2)[0])) < 1e-12
        assert abs(got[(g, "opc")] - float((wl @ x + bl)[0])) < 1e-12
    assert len(got) == 4   # rows x models


def test_stacked_linear_and_weights_table(spark):
    models = spark.createDataFrame(
        [("a", 0, [[1.0, 0.0]], [0.5]), ("b", 0, [[0.0, 2.0]], [0.0])],
        "cell_type string, layer int, weights array<array<double>>, bias array<double>")
    scorer = P.DenseStackScorer.from_weights_table(models)
    assert scorer._stacked is not None
    out = scorer.score(np.array([[1.0, 1.0], [2.0, 3.0]]))
    assert np.allclose(out, [[1.5, 2.0], [2.5, 6.0]])


def test_wide_and_combine(spark):
    long = spark.createDataFrame(
        [("S", "g1", "a", 1.0), ("S", "g1", "b", 2.0), ("S", "g2", "a", 3.0)],
        "sample_id string, gene_name string, cell_type string, prediction double")
    wide = P.predictions_wide(long, ["a", "b"])
    assert wide.columns == ["sample_id", "gene_name", "a_mean_expression_predicted_expression",
                            "b_mean_expression_predicted_expression"]
    t1 = spark.createDataFrame([("g1", 1.0), ("g2", 2.0)], "gene_name string, x double")
    t2 = spark.createDataFrame([("g1", 3.0)], "gene_name string, y double")
    assert [tuple(r) for r in P.combine_predictions([t1, t2]).collect()] == [("g1", 1.0, 3.0)]


def test_model_weights_from_file_names(spark, tmpdir_path):
    models = spark.createDataFrame([(0, [[1.0, 0.0]], [0.5])],
                                   "layer int, weights array<array<double>>, bias array<double>")
    from twasprep.schemas import MODEL_FILE_MARKER

    path = str(tmpdir_path / f"neurons{MODEL_FILE_MARKER}.parquet")
    models.write.parquet(path)
    got = P.read_model_weights(spark, path).first()
    assert got.cell_type == "neurons"


def test_row_conservation(spark):
    f = spark.createDataFrame([("S", "g1", [1.0])], "sample_id string, gene_name string, "
                                                   "features array<double>")
    p = P.predict_expression(f, P.RuleLinearScorer(["a", "b"]))
    P.require_conserved(P.row_conservation(P.distinct_genes(f), p, 2))


def test_native_and_python_engines_agree(spark):
    rng = np.random.default_rng(11)
    rows = [("S", f"g{i}", [float(v) for v in rng.normal(size=7)]) for i in range(40)]
    f = spark.createDataFrame(rows, "sample_id string, gene_name string, features array<double>")
    for scorer in (P.RuleLinearScorer(["a", "b", "c"]),
                   P.DenseStackScorer({"x": [(rng.normal(size=(1, 7)), rng.normal(size=1))],
                                       "y": [(rng.normal(size=(1, 7)), rng.normal(size=1))]})):
        nat = {(r.gene_name, r.cell_type): r.prediction
               for r in P.predict_expression(f, scorer, engine="native").collect()}
        py = {(r.gene_name, r.cell_type): r.prediction
              for r in P.predict_expression(f, scorer, engine="python").collect()}
        assert nat.keys() == py.keys() and len(nat) == 40 * len(scorer.cell_types)
        assert max(abs(nat[k] - py[k]) for k in nat) < 1e-12
    plan = P.predict_expression(f, P.RuleLinearScorer(["a"]))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "MapInPandas" not in plan
