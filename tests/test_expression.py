from conftest import write

from twasprep.operators import expression as X
from twasprep.operators import manifest as MF
from twasprep.operators import validate as VA
from twasprep.sources import tables as S

LEGACY = "_mean_expression_mean_expression_predicted_expression"


def test_rename_ignores_absent(spark):
    df = spark.createDataFrame([("g", 1.0, 2.0)], f"gene_name string, neurons{LEGACY} double, "
                                                  "other double")
    assert X.rename_predictions(df).columns == ["gene_name", "neurons_predicted", "other"]
    assert X.gene_key(spark.createDataFrame([("g",)], "first string")).columns == ["gene_name"]


def test_predictions_files_to_matrix(spark, tmpdir_path):
    d = tmpdir_path / "preds"
    write(d / "S2.csv", "gene_name,neurons_predicted,opc_predicted\ng1,1.0,2.0\ng2,3.0,4.0\n"
                        "g1,5.0,6.0\n")
    write(d / "S1.csv", "gene,neurons_predicted\ng1,7.0\ng3,8.0\n")   # no gene_name, no opc
    files = S.read_predictions_csv(spark, str(d))
    long = X.predictions_long_from_files(files, ["neurons", "opc", "astrocytes"])
    assert long.where("sample_id = 'S1' and cell_type = 'opc'").count() == 0
    miss = {(r.sample_id, r.cell_type) for r in X.missing_cell_types(files, ["neurons", "opc"])
            .collect()}
    assert miss == {("S1", "opc")}
    m = X.cell_type_matrix(long, ["S2", "S1", "S3"], order_col="ord")
    assert m.columns == ["cell_type", "gene_name", "S1", "S2", "S3"]
    got = {(r.cell_type, r.gene_name): (r.S1, r.S2, r.S3) for r in m.collect()}
    assert got[("neurons", "g1")] == (7.0, 5.0, None)      # last row of a repeated gene wins
    assert got[("opc", "g2")] == (None, 4.0, None)
    assert not [k for k in got if k[0] == "astrocytes"]       # empty cell type: no rows
    lines = {r.value for r in X.cell_type_matrix_lines(long, ["S2", "S1", "S3"], order_col="ord")
             .where("cell_type = 'neurons'").collect()}
    assert "g1,7.0,5.0," in lines


def test_unpivot_roundtrip(spark):
    wide = spark.createDataFrame([("S", "g1", 1.0, None)],
                                 "sample_id string, gene_name string, a_predicted double, "
                                 "b_predicted double")
    long = X.predictions_long(wide, ["a", "b", "c"])
    assert sorted((r.cell_type, r.prediction) for r in long.collect()) == [("a", 1.0), ("b", None)]


def test_gene_annotation_and_predictdb(spark, tmpdir_path):
    anno = write(tmpdir_path / "Gene_anno.txt",
                 "chr\tgene_id\tgene_name\tstart\n1\tENSG1\tA\t1\n1\tENSG2\tB\t2\nbad\trow\n"
                 "1\tENSG3\tA\t3\n1\tENSG2\tC\t4\n")
    ga = S.read_gene_annotation(spark, anno)
    assert ga.count() == 4
    mat = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 3.0), ("Z", 4.0)],
                                "gene_name string, S1 double")
    out = X.to_predictdb_expression(mat, ga)
    assert out.columns == ["NAME", "S1"]
    assert sorted(tuple(r) for r in out.collect()) == [("ENSG2", 2.0), ("ENSG2", 3.0),
                                                       ("ENSG3", 1.0), ("Z", 4.0)]
    assert [r.gene_name for r in X.unmapped_genes(mat, ga).collect()] == ["Z"]


def test_cell_type_matrix_reader(spark, tmpdir_path):
    path = write(tmpdir_path / "neurons_predictions.csv",
                 "junk line\nmore junk\ngene_name,S1,S2\ng1,1.0,2.0\n\ng2,3.0,\n")
    m = S.read_cell_type_matrix(spark, path)
    h = m.headers.first()
    assert h.names == ["gene_name", "S1", "S2"] and h.cell_type == "neurons"
    assert sorted(r.fields[0] for r in m.rows.collect()) == ["g1", "g2"]


def test_validate_matrix(spark):
    df = spark.createDataFrame([("g1", 1.0, 2.0), ("g1", 1.0, None), (None, 3.0, 4.0)],
                               "gene_name string, S1 double, S2 double")
    r = VA.validate_matrix(df).first()
    assert (r.n_samples, r.n_genes) == (2, 3)
    assert r.has_gene_name and not r.all_numeric and not r.no_missing_genes
    assert not r.no_duplicate_genes and r.no_duplicate_columns
    r2 = VA.validate_matrix(df, header=["gene_name", "S1", "S1"]).first()
    assert not r2.no_duplicate_columns
    ok = VA.validate_matrix(df.where("S2 is not null and gene_name is not null")).first()
    assert ok.all_numeric and ok.no_duplicate_genes and ok.no_missing_genes


def test_pending_and_summary(spark):
    inputs = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    manifest = spark.createDataFrame(
        [("predict", "a", "success", 5), ("predict", "b", "failed", 0),
         ("other", "c", "success", 1)], "stage string, key string, status string, rows long")
    assert sorted(r.key for r in MF.pending(inputs, manifest, "predict").collect()) == ["b", "c"]
    s = {r.status: (r.inputs, r.rows) for r in MF.job_summary(inputs, manifest, "predict").collect()}
    assert s == {"success": (1, 5), "failed": (1, 0), "pending": (1, 0)}


def test_unmapped_summary(spark):
    few = spark.createDataFrame([("b",), ("a",), ("c",)], "gene_name string")
    r = X.unmapped_summary(few).first()
    assert (r.n_unmapped, r.examples) == (3, "a,b,c")
    many = spark.createDataFrame([(f"g{i:02d}",) for i in range(12)], "gene_name string")
    r = X.unmapped_summary(many).first()
    assert (r.n_unmapped, r.examples) == (12, "g00,g01,g02,g03,g04")


def test_matrix_lines_dedupes_without_order(spark):
    long = spark.createDataFrame([("n", "g", "S1", 1.0), ("n", "g", "S1", 1.0)],
                                 "cell_type string, gene_name string, sample_id string, "
                                 "prediction double")
    assert [r.value for r in X.cell_type_matrix_lines(long, ["S1", "S2"]).collect()] == ["g,1.0,"]


def test_validation_report_rows(spark):
    df = spark.createDataFrame([("g1", 1.0), ("g2", None)], "gene_name string, S1 double")
    rep = {r.check: (r.passed, r.detail)
           for r in VA.validation_report(VA.validate_matrix(df)).collect()}
    assert rep["all_numeric"] == (False, "1 samples, 2 genes")
    assert rep["no_duplicate_genes"][0] is True and len(rep) == 5
