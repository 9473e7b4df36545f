import pytest

from twasprep.operators import common as C


def test_head_rows_in_order(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 9, 1)], "x long")
    assert [r.x for r in C.head_rows(df, 2, ["x"]).collect()] == [1, 3]


def test_concat_tables_by_name(spark):
    a = spark.createDataFrame([("g1", 1.0)], "gene_name string, neurons_predicted double")
    b = spark.createDataFrame([("g2", 2.0)], "gene_name string, opc_predicted double")
    out = {r.gene_name: (r.neurons_predicted, r.opc_predicted)
           for r in C.concat_tables([a, b]).collect()}
    assert out == {"g1": (1.0, None), "g2": (None, 2.0)}


def test_features_by_position_and_a_checked_width(spark):
    from twasprep.sources import tables as S

    lines = spark.createDataFrame([("f/S.csv", 0, "gene_name,a,b,c,chromo"), ("f/S.csv", 1, "g1,1,2,,chr1")],
                                  "file_path string, line_no long, value string")
    v = S.parse_feature_csv(lines, first=1, count=3).first().features
    assert v[:2] == [1.0, 2.0] and v[2] != v[2]
    for kw in ({"first": 1, "count": 9}, {"count": 2}):
        with pytest.raises(Exception, match="feature columns: f/S.csv"):
            S.parse_feature_csv(lines, **kw).collect()


def test_discover_chromosomes_from_file_names(spark, tmpdir_path):
    from conftest import write

    from twasprep.sources.text import discover_chromosomes, list_files

    for c in ("10", "2", "1", "X"):
        write(tmpdir_path / f"chr{c}_genotypes_final.txt", "varID\ts1\n")
    write(tmpdir_path / "notes.txt", "x\n")
    assert list_files(spark, str(tmpdir_path)).count() == 5
    got = [r.chromosome for r in discover_chromosomes(spark, str(tmpdir_path))
           .orderBy("chrom_rank").collect()]
    assert got == ["1", "2", "10", "X"]
    given = [r.chromosome for r in discover_chromosomes(spark, str(tmpdir_path), chromosomes="2,1")
             .orderBy("chrom_rank").collect()]
    assert given == ["1", "2"]
