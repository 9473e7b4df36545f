import math

from conftest import write

from twasprep.operators import features as FT
from twasprep.sources import tables as S


def test_region_bin_means(spark):
    t = spark.createDataFrame(
        [("S1", "chr1_1000_2000", [[1.0, 2.0, 3.0], [3.0, 2.0, 1.0], [1.0, 2.0, 3.0], [3.0, 2.0, 1.0]]),
         ("S1", "chr2_5_9", [[1.0, float("nan")], [3.0, 1.0]]),
         ("S1", "bad", [[1.0, 2.0], [1.0]]),
         ("S1", "nounderscore", [[4.0]])],
        "sample_id string, region string, bins array<array<float>>")
    got = {r.region: (r.chromo, r.features) for r in FT.region_bin_means(t).collect()}
    assert got["chr1_1000_2000"] == ("chr1", [2.0, 2.0, 2.0])
    assert got["chr2_5_9"][1][0] == 2.0 and math.isnan(got["chr2_5_9"][1][1])
    assert "bad" not in got
    assert got["nounderscore"] == ("nounderscore", [4.0])
    assert FT.region_bin_means(t, keep_rejects=True).where("features is null").count() == 1


def _windows_features(spark):
    windows = spark.createDataFrame(
        [("G1", "r1|r2|r2"), ("G2", "r3"), ("G3", None), ("G4", "r99"), ("G5", "r2|r3"),
         ("G6", "")], "gene_name string, region_names string")
    feats = spark.createDataFrame(
        [("S", "r1", 0, [1.0, 1.0]), ("S", "r2", 1, [3.0, 3.0]), ("S", "r3", 2, [9.0, 9.0])],
        "sample_id string, region string, ord long, features array<double>")
    return windows, feats


def test_gene_region_means(spark):
    windows, feats = _windows_features(spark)
    got = {r.gene_name: r.features for r in FT.gene_region_means(windows, feats).collect()}
    assert got == {"G1": [2.0, 2.0], "G2": [9.0, 9.0], "G5": [6.0, 6.0]}


def test_duplicate_feature_rows_each_count(spark):
    windows, feats = _windows_features(spark)
    dup = feats.unionByName(spark.createDataFrame(
        [("S", "r1", 3, [4.0, 4.0])], "sample_id string, region string, ord long, features array<double>"))
    got = {r.gene_name: r.features for r in FT.gene_region_means(windows, dup).collect()}
    assert got["G1"] == [(1.0 + 3.0 + 4.0) / 3] * 2


def test_chunked_and_first_chunk(spark):
    windows, feats = _windows_features(spark)
    chunked = {(r.gene_name, r.chunk): r.features
               for r in FT.gene_region_means(windows, feats, chunk_rows=2).collect()}
    assert chunked[("G5", 0)] == [3.0, 3.0] and chunked[("G5", 1)] == [9.0, 9.0]
    first = {r.gene_name: r.features for r in FT.first_chunk_means(windows, feats, 2).collect()}
    assert first["G5"] == [3.0, 3.0]
    # chunked equals unchunked when one chunk holds every row
    big = {r.gene_name: r.features for r in FT.first_chunk_means(windows, feats, 1000).collect()}
    assert big == {r.gene_name: r.features for r in FT.gene_region_means(windows, feats).collect()}


def test_feature_csv_reader_and_windows_csv(spark, tmpdir_path):
    path = write(tmpdir_path / "SAMPLE1_processed.csv",
                 "gene_name,0,1,2,chromo\nchr1_10_20,1.5,2.5,,chr1\nchr2_5_6,1,2,3,chr2\n")
    rows = {r.gene_name: r for r in S.read_feature_csv(spark, path).collect()}
    assert rows["chr2_5_6"].features == [1.0, 2.0, 3.0]
    assert rows["chr1_10_20"].features[:2] == [1.5, 2.5] and math.isnan(rows["chr1_10_20"].features[2])
    assert rows["chr1_10_20"].chromo == "chr1" and rows["chr1_10_20"].sample_id == "SAMPLE1"
    dense = {r.gene_name: r.ord for r in S.read_feature_csv(spark, path, numbering="dense").collect()}
    assert dense == {"chr1_10_20": 0, "chr2_5_6": 1}
    wpath = write(tmpdir_path / "windows.csv", "gene_name,region_names\nG1,a|b\nG2,\n")
    w = S.read_gene_windows(spark, wpath)
    assert FT.window_pairs(w).count() == 2
