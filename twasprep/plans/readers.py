"""Registered queries that put the text readers and the model table under the
gate: Spark renders benchmark tables as text lines (``file_path, line_no,
value``), with the irregular rows real files have, and the readers parse them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twasprep.operators import common as C
from twasprep.operators import expression as X
from twasprep.operators import features as FT
from twasprep.operators import predict as P
from twasprep.operators import validate as VA
from twasprep.plans import driver_views as V
from twasprep.plans.tables import table_path
from twasprep.plans.workflows import transform_job
from twasprep.schemas import LEGACY_OUTPUT_SUFFIX
from twasprep.sinks import writers as W
from twasprep.sinks.ledger import text_digest
from twasprep.sources import tables as S
from twasprep.sources.text import chromosomes_of, list_files, parse_sample_list

_DIGITS = 6
HEAD = 25  # rows of the head report


def _headers(spark: SparkSession, lines: list[tuple[str, int, str]]) -> DataFrame:
    return spark.createDataFrame(lines, "file_path string, line_no long, value string")


def _line(path: str, number: Column, sep: str, *cells) -> list[Column]:
    return [F.lit(path).alias("file_path"), number.cast("long").alias("line_no"),
            F.array_join(F.array(*[F.coalesce(c.cast("string"), F.lit("")) for c in cells]), sep)
            .alias("value")]


# --- SNP annotation with all, reordered and missing columns ----------------
def snp_lines(spark, sf_dir) -> DataFrame:
    """Part k in one of three files: all columns; reversed without ids; with an
    extra column and without R2. MAF is NA, empty or a number."""
    p = V.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    c = {"chromosome": k % 22 + 1, "pos": k * 10, "varID": F.concat(F.lit("v"), k.cast("string")),
         "ref_vcf": F.lit("A"), "alt_vcf": F.lit("C"), "R2": F.lit("0.9"),
         "MAF": F.when(k % 5 == 0, "NA").when(k % 5 == 1, "").otherwise("0.25"),
         "rsid": F.concat(F.lit("rs"), k.cast("string")), "rsid_dbSNP150": F.lit("."),
         "note": F.lit("x")}
    full = [n for n in c if n != "note"]
    files = [("snp/a.txt", full), ("snp/b.txt", full[:7][::-1]),
             ("snp/c.txt", ["varID", "note", *[n for n in full if n not in ("varID", "R2")]])]
    out = _headers(spark, [(f, 0, "\t".join(names)) for f, names in files])
    for i, (f, names) in enumerate(files):
        out = out.unionByName(p.where(k % 3 == i).select(*_line(f, k + 1, "\t", *[c[n] for n in names])))
    return out


def q_snp_annotation_scan(spark, sf_dir):
    return S.parse_snp_annotation(snp_lines(spark, sf_dir))


# --- prediction CSVs with differing headers ---------------------------------
_OLD = LEGACY_OUTPUT_SUFFIX


def prediction_lines(spark, sf_dir) -> DataFrame:
    """Customer k in one of three files: neurons and a note; a segment and two
    cell types; a key column of another name. Genes repeat within a file."""
    t = V.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    gene = F.concat(F.lit("G"), (k % 50).cast("string"))
    files = [("pred/A.b.csv", f"gene_name,neurons{_OLD},note", [gene, k, F.lit("n")]),
             ("pred/B.csv_predicted_expressions.csv", f"gene_name,segment,opc{_OLD},neurons{_OLD}",
              [gene, F.col("c_mktsegment"), k, F.when(k % 4 == 0, "").otherwise("2")]),
             ("pred/C.csv", f"id,neurons{_OLD}", [gene, k])]
    out = _headers(spark, [(f, 0, h) for f, h, _ in files])
    for i, (f, _, cells) in enumerate(files):
        out = out.unionByName(t.where(k % 3 == i).select(*_line(f, k + 1, ",", *cells)))
    return out


def q_rename_rows(spark, sf_dir):
    return X.csv_lines(X.rename_headers(S.parse_predictions_csv(prediction_lines(spark, sf_dir))))


def q_prediction_csv_scan(spark, sf_dir):
    files = X.rename_headers(S.parse_predictions_csv(prediction_lines(spark, sf_dir)))
    return X.predictions_long_from_files(files)


# --- gene annotation, dbSNP, feature CSVs ------------------------------------
def q_gene_annotation_scan(spark, sf_dir):
    """Rows of region 4 have two fields and are skipped; others end in a tab."""
    n = V.table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    ensembl = F.concat(F.lit("ENSG"), k.cast("string"))
    short = n.where(F.col("n_regionkey") == 4).select(*_line("g.txt", k + 1, "\t", F.lit("1"), ensembl))
    rows = n.where(F.col("n_regionkey") != 4).select(
        *_line("g.txt", k + 1, "\t", F.lit("1"), ensembl, F.col("n_name"), F.lit("")))
    lines = _headers(spark, [("g.txt", 0, "chr\tgene_id\tgene_name")]).unionByName(short)
    return S.parse_gene_annotation(lines.unionByName(rows))


def q_dbsnp_scan(spark, sf_dir):
    """Part k; every 11th has no number as its position, every 13th four fields."""
    p = V.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    pos = F.when(k % 11 == 0, F.lit("x")).otherwise((k * 10).cast("string"))
    first = [k % 22 + 1, pos, F.concat(F.lit("rs"), k.cast("string")), F.lit("A")]
    rows = p.where(k % 13 != 0).select(*_line("d.vcf", k + 1, "\t", *first, F.lit("C,G"), F.lit(".")))
    short = p.where(k % 13 == 0).select(*_line("d.vcf", k + 1, "\t", *first))
    lines = _headers(spark, [("d.vcf", 0, "##x"), ("d.vcf", 1, "#CHROM\tPOS\tID\tREF\tALT")])
    return S.parse_dbsnp_vcf(lines.unionByName(rows).unionByName(short))


def feature_lines(spark, sf_dir) -> DataFrame:
    """Vector v in the file of sample v mod 3; sample 2's file has another column
    order and no chromosome; every fifth value is empty (NaN, shown as -1)."""
    e = V.table(spark, sf_dir, "embeddings")
    v = F.col("vec_id")
    cells = {"gene_name": F.concat(F.lit("g"), v.cast("string")), "0": v,
             "1": F.when(v % 5 == 0, "").otherwise((v % 7).cast("string")), "2": F.lit("0.5"),
             "chromo": F.concat(F.lit("chr"), (v % 22).cast("string"))}
    orders = [["gene_name", "0", "1", "2", "chromo"]] * 2 + [["gene_name", "2", "1", "0"]]
    files = [f"f/S{i}_processed.csv" for i in range(3)]
    lines = _headers(spark, [(f, 0, ",".join(o)) for f, o in zip(files, orders)])
    for i, (f, o) in enumerate(zip(files, orders)):
        lines = lines.unionByName(e.where(v % 3 == i).select(*_line(f, v + 1, ",", *[cells[c] for c in o])))
    return lines


def _exploded(feats: DataFrame) -> DataFrame:
    return feats.select("sample_id", "gene_name", "chromo", F.posexplode("features").alias("idx", "x")) \
        .select("sample_id", "gene_name", "chromo", "idx", F.nanvl("x", F.lit(-1.0)).alias("value"))


def q_feature_csv_scan(spark, sf_dir):
    return _exploded(S.parse_feature_csv(feature_lines(spark, sf_dir), dense=True, count=3))


def q_feature_csv_positional(spark, sf_dir):
    """The same files by position: columns 1 to 3, whatever their names."""
    return _exploded(S.parse_feature_csv(feature_lines(spark, sf_dir), first=1, count=3))


# --- sample list, gene windows, file names, several tables as one ------------
def q_sample_list_scan(spark, sf_dir):
    """Suppliers as lines of a list: blanks around every third id, every seventh blank."""
    t = V.table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    name = F.when(k % 7 == 0, F.lit("  ")).when(k % 3 == 0, F.concat(F.lit(" "), "s_name", F.lit(" "))) \
        .otherwise(F.col("s_name"))
    return parse_sample_list(t.select(*_line("samples.txt", k, "", name)))


def q_gene_windows_scan(spark, sf_dir):
    """The gene windows written as CSV with a header and read back, as pairs."""
    path = table_path(spark)
    V.gene_windows(spark, sf_dir).write.option("header", "true").csv(path)
    return FT.window_pairs(S.read_gene_windows(spark, path))


def q_discovered_chromosomes(spark, sf_dir):
    """Variants written to files named by chromosome: the names in natural order."""
    path = table_path(spark)
    v = V.variant_annotation_rows(spark, sf_dir).select("varid", F.concat(
        F.lit("chr"), F.regexp_replace("chrom", "^chr", ""), F.lit("_variants")).alias("name"))
    v.write.partitionBy("name").text(path)
    files = list_files(spark, path, recursive=True).select(F.regexp_extract(
        "path", "/name=([^/]+)/", 1).alias("file_name"))
    return chromosomes_of(files)


def q_head_variants(spark, sf_dir):
    """The first rows by position and id: a report of fixed length is the feature."""
    return C.head_rows(V.variant_annotation_rows(spark, sf_dir), HEAD, ["pos", "varid"])


def q_concat_tables(spark, sf_dir):
    """Predictions whose files differ in their columns, as one table."""
    t = V.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    gene = F.concat(F.lit("G"), k.cast("string")).alias("gene_name")
    return C.concat_tables([
        t.where(k % 3 == 0).select(gene, k.alias("neurons_predicted")),
        t.where(k % 3 == 1).select((k * 2).alias("opc_predicted"), gene),
        t.where(k % 3 == 2).select(gene, k.alias("neurons_predicted"), (-k).alias("opc_predicted"))])


def q_transform_files(spark, sf_dir):
    """Comma-separated matrices through the transform job: the tab-separated text
    that it wrote, per cell type (cells as they were, keys mapped)."""
    base = table_path(spark)
    t = V.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    rows = t.select(F.element_at(F.array(F.lit("neurons"), F.lit("opc")), (k % 2 + 1).cast("int")).alias("cell_type"),
                    F.concat(F.lit("GENE"), F.col("c_nationkey").cast("string")).alias("gene"), k.alias("a"),
                    F.when(k % 5 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("b"))
    lines = rows.select("cell_type", F.concat_ws(",", "gene", F.col("a").cast("string"), "b").alias("value"))
    W.write_lines_with_header(lines, "gene_name,S2,S1", f"{base}/m", partition_by="cell_type")
    n = V.table(spark, sf_dir, "nation")
    anno = n.where(F.col("n_regionkey") != 4).select(F.concat_ws(
        "\t", F.lit("1"), F.concat(F.lit("ENSG"), F.col("n_nationkey").cast("string")),
        F.concat(F.lit("GENE"), F.col("n_nationkey").cast("string"))).alias("value"))
    W.write_lines_with_header(anno.coalesce(1), "chr\tgene_id\tgene_name", f"{base}/anno")
    transform_job(spark, f"{base}/m", f"{base}/anno", f"{base}/out")
    return text_digest(spark, f"{base}/out", "cell_type")


# --- matrix files -------------------------------------------------------------
def matrix_file_lines(spark, sf_dir) -> DataFrame:
    """Customer k as a row of three matrices: a sound one below a junk line; one
    with a repeated column, repeated genes and some text cells; one without header."""
    t = V.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    gene = F.concat(F.lit("g"), k.cast("string"))
    a, b, c = "m/neurons_predictions.csv", "m/opc_predictions.csv", "m/ast_predictions.csv"
    lines = _headers(spark, [(a, 0, "made by a tool"), (a, 1, "gene_name,A,B"), (b, 0, "gene_name,A,A")])
    few = F.concat(F.lit("g"), (k % 10).cast("string"))
    word = F.when(k % 9 == 0, F.col("c_mktsegment")).otherwise(F.lit("1.5"))
    return lines.unionByName(t.select(*_line(a, k + 2, ",", gene, k, F.lit("0.5")))) \
        .unionByName(t.select(*_line(b, k + 1, ",", few, k, word))) \
        .unionByName(t.select(*_line(c, k + 1, ",", gene, k)))


def q_matrix_file_checks(spark, sf_dir):
    return VA.validate_files(S.parse_cell_type_matrix(matrix_file_lines(spark, sf_dir)))


CHECKED_ROWS = 5  # rows of each file in the quick look


def q_matrix_checks_sampled(spark, sf_dir):
    return VA.validate_files(S.parse_cell_type_matrix(matrix_file_lines(spark, sf_dir)), CHECKED_ROWS)


# --- model table ----------------------------------------------------------------
MODEL_TYPES = ("neurons", "opc", "pericytes")


def model_table(spark, sf_dir) -> DataFrame:
    """Two dense layers per cell type from mean embeddings: of the seven groups
    vec_id mod 7, groups 2k and 2k+1 are the hidden units of model k and the
    first two means of group 6 its output weights."""
    e = V.table(spark, sf_dir, "embeddings")
    cells = e.select((F.col("vec_id") % 7).alias("g"),
                     F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x"))
    means = cells.groupBy("g", "i").agg(F.avg("x").alias("x")).groupBy("g").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("w"))
    names = F.array(*[F.lit(t) for t in MODEL_TYPES])
    hidden = means.where("g < 6").groupBy(F.floor(F.col("g") / 2).cast("int").alias("k")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("g", "w"))), lambda s: s["w"]).alias("weights"))
    hidden = hidden.select(F.get(names, F.col("k")).alias("cell_type"), F.lit(0).alias("layer"), "weights",
                           F.array(F.lit(0.1), F.lit(-0.1)).alias("bias"))
    last = means.where("g = 6").select(
        F.explode(names).alias("cell_type"), F.lit(1).alias("layer"),
        F.array(F.slice("w", 1, 2)).alias("weights"), F.array(F.lit(0.25)).alias("bias"))
    return hidden.unionByName(last)


def _dense(spark, sf_dir, activation=None):
    scorer = P.DenseStackScorer.from_weights_table(model_table(spark, sf_dir), activation)
    out = P.predict_expression(P.zscore_features(V.gene_features(spark, sf_dir)), scorer)
    return out.withColumn("prediction", F.round("prediction", _DIGITS) + 0.0)


def q_predict_dense(spark, sf_dir):
    return _dense(spark, sf_dir)


def q_predict_sigmoid(spark, sf_dir):
    return _dense(spark, sf_dir, "sigmoid")


QUERIES = {f.__name__[2:]: f for f in (
    q_snp_annotation_scan, q_rename_rows, q_prediction_csv_scan, q_gene_annotation_scan,
    q_dbsnp_scan, q_feature_csv_scan, q_feature_csv_positional, q_sample_list_scan, q_gene_windows_scan,
    q_discovered_chromosomes, q_head_variants, q_concat_tables, q_transform_files, q_matrix_file_checks, q_matrix_checks_sampled,
    q_predict_dense, q_predict_sigmoid)}
