"""Samples are scored when all of their files have landed, and once."""

import glob

import pytest
from pyspark.sql import functions as F

from twasprep.operators import predict as P
from twasprep.streaming import run_file_batches, stream_scores
from twasprep.streaming.landing import SampleScores

ROWS = "gene_name string, features array<double>, ord long"


def _land(spark, path, genes):
    spark.createDataFrame([(g, [float(i), float(i * i % 7)], i) for g, i in genes], ROWS) \
        .coalesce(1).write.parquet(path)


def _rows(state):
    return sorted((r.sample_id, r.gene_name, r.cell_type, round(r.prediction, 9))
                  for r in state.predictions().collect())


def _tables(out):
    return {p: open(p, "rb").read() for p in glob.glob(f"{out}/**/part-*.parquet", recursive=True)}


def test_a_sample_waits_for_its_last_file_and_a_replay_changes_nothing(spark, tmpdir_path):
    land, out, check = (str(tmpdir_path / x) for x in ("in", "out", "check"))
    scorer = P.RuleLinearScorer(["neurons", "opc"])
    expected = spark.createDataFrame([("A", 2), ("B", 1), ("C", 1)], "sample_id string, files long")
    _land(spark, f"{land}/sample_id=A/one", [("g1", 1), ("g2", 2)])
    _land(spark, f"{land}/sample_id=B/one", [("g1", 5), ("g2", 3), ("g3", 4), ("g1", 9)])
    by_folder = lambda path: F.regexp_extract(path, "/sample_id=([^/]+)/", 1)
    run = lambda: stream_scores(spark, land, expected, scorer, out, check, sample_of=by_folder)
    assert {r[0] for r in _rows(run())} == {"B"}
    _land(spark, f"{land}/sample_id=A/two", [("g3", 4), ("g4", 8)])
    state = run()
    rows = _rows(state)
    assert {r[0] for r in rows} == {"A", "B"} and len(rows) == (4 + 3) * 2
    # the whole sample is normalised together, though its files came in two batches
    feats = spark.createDataFrame([("A", g, [float(i), float(i * i % 7)], i) for g, i in
                                   [("g1", 1), ("g2", 2), ("g3", 4), ("g4", 8)]], f"sample_id string, {ROWS}")
    want = sorted((r.sample_id, r.gene_name, r.cell_type, round(r.prediction, 9)) for r in
                  P.predict_expression(P.zscore_features(feats), scorer).collect())
    assert [r for r in rows if r[0] == "A"] == want
    assert {(r.sample_id, r.genes, r.predictions) for r in state.scored().collect()} == {("A", 4, 8), ("B", 3, 6)}
    before = {p.split("/part-")[0]: None for p in _tables(out)}
    # the same batches again, in any order: same folders, same rows
    for batch_id in (1, 0):
        files = state.arrived().where(F.col("batch") == batch_id).select("path").withColumn("length", F.lit(1))
        SampleScores(spark, out, expected, scorer, by_folder).batch(files, batch_id)
    assert _rows(state) == rows and {p.split("/part-")[0]: None for p in _tables(out)} == before
    assert _rows(run()) == rows                              # nothing new has landed


def test_missing_predictions_are_told_by_sample(spark):
    genes = spark.createDataFrame([("A", 2), ("B", 1), ("C", 1)], "sample_id string, genes long")
    preds = spark.createDataFrame([("A",)] * 4 + [("B",)] + [("D",)], "sample_id string")
    kept = {r.sample_id: (r.genes, r.predictions, r.conserved) for r in P.row_conservation(genes, preds, 2).collect()}
    assert kept == {"A": (2, 4, True), "B": (1, 1, False), "C": (1, 0, False), "D": (0, 1, False)}
    with pytest.raises(ValueError, match="sample B: 1 genes, 1 predictions; sample C: 1 genes, 0"):
        P.require_conserved(P.row_conservation(genes, preds, 2))


def test_file_batches_carry_names_only(spark, tmpdir_path):
    (tmpdir_path / "in").mkdir()
    (tmpdir_path / "in" / "empty.vcf").write_text("")
    (tmpdir_path / "in" / "x y.vcf").write_text("##x\n")
    seen = []
    run_file_batches(spark, str(tmpdir_path / "in"), str(tmpdir_path / "c"), lambda s, paths, i: seen.extend(paths))
    assert [p.rsplit("/", 1)[1] for p in seen] == ["x y.vcf"]
