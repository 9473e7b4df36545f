"""Readers for the delimited intermediate files of the workflow.

Wide files (thousands of feature or sample columns) are parsed from text
into one array column: a header row per file is joined back by broadcast
(one small row per file) and cells are located by header position, so no
plan ever carries thousands of scalar columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twasprep.schemas import SNP_ANNOTATION, UNRESOLVED_RSID
from twasprep.sources.bgzip import read_gzip_lines
from twasprep.sources.text import list_files, read_lines, sample_from_path


@dataclass(frozen=True)
class HeaderedRows:
    """``rows``: file_path, line_no, fields array<string>; ``headers``:
    file_path, names array<string>. Cells are looked up by name per file."""

    rows: DataFrame
    headers: DataFrame

    def joined(self) -> DataFrame:
        return self.rows.join(F.broadcast(self.headers), "file_path")


#: What is taken off a CSV file's name to get its sample (the prediction stage
#: names its files ``<sample>.csv_predicted_expressions.csv``).
CSV_SUFFIX = r"(\.csv)?(_predicted_expressions)?\.csv(\.gz|\.bz2)?$"


def _strip(value: Column | str) -> Column:
    """Blanks of every kind removed from both ends (``trim`` knows spaces only)."""
    return F.btrim(F.col(value) if isinstance(value, str) else value, F.lit(" \t\r\n\x0b\f"))


def _split_ws(value: Column) -> Column:
    return F.split(_strip(value), r"\s+")


def parse_dosage_matrix(lines: DataFrame, header_token: str = "varID") -> HeaderedRows:
    """Genotype matrix lines (``file_path, line_no, value``): a header
    ``varID <samples>`` then rows ``varID d d ...``.

    The header is the line whose first field is ``header_token`` (the matrix
    writer always puts it first), so any line numbering works and the scan is
    single-pass. Fields split on any whitespace run (rows may be tab- or
    space-delimited); rows with fewer than two fields are skipped. ``fields``
    holds the dosage tokens only; the header ``names`` the sample ids.
    """
    tokens = lines.select("file_path", "line_no", _split_ws(F.col("value")).alias("t"))
    is_header = F.element_at("t", 1) == F.lit(header_token)
    headers = (tokens.where(is_header)
               .select("file_path", F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0)))
                       .alias("names")))
    rows = (tokens.where(~is_header & (F.size("t") >= 2))
            .select("file_path", "line_no", F.element_at("t", 1).alias("varid"),
                    F.slice("t", 2, F.size("t") - 1).alias("fields")))
    return HeaderedRows(rows=rows, headers=headers)


def read_dosage_matrix(spark: SparkSession, path: str | list[str],
                       path_glob: str | None = None, keep_path=None) -> HeaderedRows:
    """Scan genotype matrix text files in one pass (see ``parse_dosage_matrix``)."""
    return parse_dosage_matrix(read_lines(spark, path, numbering="order", path_glob=path_glob,
                                          keep_path=keep_path))


def parse_variant_annotation(lines: DataFrame, rejects: bool = False) -> DataFrame:
    """Headerless ``varID chrom pos ref alt`` lines (whitespace-delimited).

    Rows with fewer than five fields are skipped. Rows with more than five
    fields cannot be unpacked; they are returned when ``rejects=True`` and
    excluded otherwise.
    """
    t = lines.select("file_path", "line_no", "value", _split_ws(F.col("value")).alias("t"))
    if rejects:
        return t.where(F.size("t") > 5).select("file_path", "line_no", "value")
    t = t.where(F.size("t") == 5)
    return t.select(
        F.element_at("t", 1).alias("varid"),
        F.element_at("t", 2).alias("chrom"),
        F.element_at("t", 3).try_cast("long").alias("pos"),
        F.element_at("t", 4).alias("ref"),
        F.element_at("t", 5).alias("alt"),
        "file_path",
        "line_no",
    )


def read_variant_annotation(spark: SparkSession, path: str | list[str],
                            rejects: bool = False, path_glob: str | None = None,
                            keep_path=None) -> DataFrame:
    """Scan headerless variant annotation files in one pass (see
    ``parse_variant_annotation``)."""
    return parse_variant_annotation(
        read_lines(spark, path, numbering="order", path_glob=path_glob, keep_path=keep_path),
        rejects)


def parse_snp_annotation(lines: DataFrame, with_file: bool = False) -> DataFrame:
    """SNP annotation lines (tab-separated, with a header) by column name.

    The header is the line that names ``varID`` and ``pos``; every file is read
    by its own, so columns may be missing or stand in another order: missing
    ids are ``.``, other missing columns NULL. ``NA`` and empty cells are NULL.
    A file without a header is an error.
    """
    f = lines.select("file_path", "line_no", F.split(F.rtrim(F.col("value"), F.lit("\r")), "\t")
                     .alias("f"))
    is_header = F.array_contains("f", "varID") & F.array_contains("f", "pos")
    # part files of one writer repeat their header: one is enough
    headers = f.where(is_header).groupBy("file_path").agg(F.min_by("f", "line_no").alias("names"))
    j = f.where(~is_header & (F.array_join("f", "") != "")).join(headers, "file_path", "left")
    names = F.when(F.col("names").isNotNull(), F.col("names")).otherwise(F.raise_error(
        F.concat(F.lit("SNP annotation without a header: "), F.col("file_path")))
        .cast("array<string>"))

    def cell(field):
        at = F.array_position(F.col("_names"), field.name).cast("int")
        text = F.when(at > 0, F.try_element_at("f", at))
        value = F.when(~text.isin("", "NA"), text).try_cast(field.dataType)
        if field.name.startswith("rsid"):
            value = F.when(at == 0, F.lit(UNRESOLVED_RSID)).otherwise(value)
        return value.alias(field.name)

    j = j.withColumn("_names", names)
    extra = [F.col("file_path"), F.col("line_no").alias("file_order")] if with_file else []
    return j.select(*[cell(c) for c in SNP_ANNOTATION.fields], *extra)


def read_snp_annotation(spark: SparkSession, path: str | list[str], with_file: bool = False
                        ) -> DataFrame:
    """Scan SNP annotation files (see ``parse_snp_annotation``). ``with_file``
    adds ``file_path`` and ``file_order`` (split offset, then row in the split)."""
    return parse_snp_annotation(read_lines(spark, path, numbering="order"), with_file)


def read_dbsnp_vcf(spark: SparkSession, path: str | list[str], numbering: str = "order",
                   split_gzip: bool = False) -> DataFrame:
    """Scan dbSNP VCF files (see ``parse_dbsnp_vcf``); ``split_gzip`` reads block-gzip
    files by several tasks each (see ``sources.bgzip``)."""
    if split_gzip:
        files = list_files(spark, path, recursive=True).where(F.col("file_name").rlike(r"\.(gz|bgz)$"))
        return parse_dbsnp_vcf(read_gzip_lines(spark, sorted(r.path for r in files.select("path").collect())))
    return parse_dbsnp_vcf(read_lines(spark, path, numbering=numbering))


def parse_dbsnp_vcf(lines: DataFrame) -> DataFrame:
    """dbSNP VCF lines -> ``chrom, pos, rsid, ref, alt, ord``, in one pass.

    Records with fewer than five fields or a non-integer position are
    skipped. ``ord`` orders records as in the file and fixes "first record
    wins" (a struct key with the default single-pass numbering; the dense
    line number with ``numbering='dense'``).
    """
    body = lines.where(~F.col("value").startswith("#"))
    f = F.split("value", "\t")
    out = body.select(
        F.try_element_at(f, F.lit(1)).alias("chrom"),
        F.try_element_at(f, F.lit(2)).try_cast("long").alias("pos"),
        F.try_element_at(f, F.lit(3)).alias("rsid"),
        F.try_element_at(f, F.lit(4)).alias("ref"),
        F.try_element_at(f, F.lit(5)).alias("alt"),
        F.col("line_no").alias("ord"),
        F.size(f).alias("_n"),
    )
    return out.where((F.col("_n") >= 5) & F.col("pos").isNotNull()).drop("_n")


def read_gene_windows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Gene-window CSV with header: ``gene_name, region_names`` (``|`` list)."""
    return spark.read.option("header", "true").csv(path)


def _numeric_positions(names: Column) -> Column:
    """1-based positions of header names that are integers (feature columns)."""
    return F.filter(F.sequence(F.lit(1), F.size(names)),
                    lambda i: F.element_at(names, i).rlike(r"^[0-9]+$"))


def read_feature_csv(spark: SparkSession, path: str | list[str], key: str = "gene_name",
                     sample_suffix: str = r"(_processed)?(_mean_features)?(\.csv)?(\.gz)?$",
                     path_glob: str | None = None, numbering: str = "order",
                     first: int | None = None, count: int | None = None) -> DataFrame:
    """Scan wide feature CSVs (see ``parse_feature_csv``); pass
    ``numbering='dense'`` for an ``ord`` of 0-based row positions (needed only by
    the chunked legacy mean)."""
    lines = read_lines(spark, path, numbering=numbering, path_glob=path_glob)
    return parse_feature_csv(lines, key, sample_suffix, dense=numbering == "dense", first=first, count=count)


def parse_feature_csv(lines: DataFrame, key: str = "gene_name",
                      sample_suffix: str = r"(_processed)?(_mean_features)?(\.csv)?(\.gz)?$",
                      dense: bool = False, first: int | None = None, count: int | None = None) -> DataFrame:
    """Wide feature CSV lines (key column, ``0..n-1`` feature columns, extras).

    Returns ``sample_id, <key>, ord, features array<double>`` (plus
    ``chromo`` when the file has it). The header is the line whose first
    field is ``key``; cells are located by header position per file. Empty
    or non-numeric cells become NaN, as a float parse of a missing value
    does. The sample id is the file's base name without the stage suffixes.

    ``ord`` keeps file order; with ``dense`` line numbers it is the 0-based row
    position. ``first`` and ``count`` take the features by position instead (columns
    ``first`` to ``first + count - 1``, the key being column 0), whatever their
    names; ``count`` alone checks the number of named ones. A file with another
    width is an error.
    """
    fields = lines.select("file_path", "line_no", F.split("value", ",").alias("f"))
    is_header = F.element_at("f", 1) == F.lit(key)
    headers = fields.where(is_header).select("file_path", F.col("f").alias("names"))
    rows = fields.where(~is_header & (F.size("f") > 1))
    j = rows.join(F.broadcast(headers), "file_path")
    pos = _numeric_positions(F.col("names"))
    if first is not None:
        pos = F.sequence(F.lit(first + 1), F.least(F.lit(first + count), F.size("names")))
    if count is not None:
        pos = F.when(F.size(pos) == count, pos).otherwise(F.raise_error(F.concat(
            F.lit(f"not {count} feature columns: "), F.col("file_path"))).cast("array<int>"))
    key_idx = F.array_position("names", key)
    chromo_idx = F.array_position("names", "chromo")
    features = F.transform(pos, lambda i: F.coalesce(
        F.try_element_at("f", i.cast("int")).try_cast("double"), F.lit(float("nan"))))
    # a partitioned export carries the sample in its directory name
    sample = sample_from_path("file_path", sample_suffix)
    order = F.col("line_no") - 1 if dense else F.col("line_no")
    return j.select(
        sample.alias("sample_id"),
        F.when(key_idx > 0, F.try_element_at("f", key_idx.cast("int")))
        .otherwise(F.element_at("f", 1)).alias(key),
        F.when(chromo_idx > 0, F.try_element_at("f", chromo_idx.cast("int"))).alias("chromo"),
        order.alias("ord"),
        features.alias("features"),
    )


def read_predictions_csv(spark: SparkSession, path: str | list[str],
                         path_glob: str | None = None) -> HeaderedRows:
    """Scan per-sample prediction CSVs (see ``parse_predictions_csv``)."""
    return parse_predictions_csv(read_lines(spark, path, path_glob=path_glob))


def parse_predictions_csv(lines: DataFrame) -> HeaderedRows:
    """Prediction CSV lines (``gene_name`` + one column per cell type).

    Files may differ in their column sets; cells are looked up per file by
    header name. ``sample_id`` is the file name without its known
    endings (``CSV_SUFFIX``), so names that hold dots stay apart.
    """
    fields = lines.select("file_path", "line_no", F.split("value", ",").alias("f"))
    headers = (fields.where(F.col("line_no") == 0)
               .select("file_path", F.col("f").alias("names"),
                       sample_from_path("file_path", CSV_SUFFIX).alias("sample_id")))
    rows = (fields.where((F.col("line_no") > 0) & (F.length(F.array_join("f", "")) > 0))
            .select("file_path", "line_no", F.col("f").alias("fields")))
    return HeaderedRows(rows=rows, headers=headers)


def read_gene_annotation(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scan gene annotation files (see ``parse_gene_annotation``)."""
    return parse_gene_annotation(read_lines(spark, path))


def parse_gene_annotation(lines: DataFrame) -> DataFrame:
    """Gene annotation lines: header skipped, column 2 Ensembl id, column 3 name.

    Rows with fewer than three tab fields are skipped. ``ord`` keeps file
    order for "last definition wins".
    """
    f = F.split(_strip("value"), "\t")
    return (lines.where(F.col("line_no") > 0)
            .select(f.alias("f"), "line_no", "file_path")
            .where(F.size("f") >= 3)
            .select(F.element_at("f", 3).alias("gene_name"),
                    F.element_at("f", 2).alias("ensembl_id"),
                    F.col("line_no").alias("ord")))


def read_cell_type_matrix(spark: SparkSession, path: str | list[str],
                          path_glob: str | None = None) -> HeaderedRows:
    """Scan cell-type matrix CSVs (see ``parse_cell_type_matrix``)."""
    return parse_cell_type_matrix(read_lines(spark, path, path_glob=path_glob))


def parse_cell_type_matrix(lines: DataFrame) -> HeaderedRows:
    """Gene x sample CSV lines whose header is the first one starting ``gene_name``.

    Lines above the header and blank lines are dropped; fields are split on
    commas without quoting (as the matrices are written). ``headers`` also
    carries ``cell_type`` = file stem without ``_predictions``, and has a row
    with NULL ``names`` for every file without a header (a failed input).
    """
    stripped = lines.select("file_path", "line_no", _strip("value").alias("v"))
    is_header = F.col("v").startswith("gene_name")
    first = stripped.groupBy("file_path").agg(
        F.min(F.when(is_header, F.struct("line_no", "v"))).alias("_h"))
    headers = first.select(
        "file_path", F.split("_h.v", ",").alias("names"),
        F.regexp_replace(sample_from_path("file_path", partition_key="cell_type"),
                         "_predictions$", "").alias("cell_type"))
    starts = first.where(F.col("_h").isNotNull()).select("file_path", F.col("_h.line_no").alias("_at"))
    rows = (stripped.join(starts, "file_path")
            .where((F.col("line_no") > F.col("_at")) & (F.length("v") > 0))
            .select("file_path", "line_no", F.split("v", ",").alias("fields")))
    return HeaderedRows(rows=rows, headers=headers)
