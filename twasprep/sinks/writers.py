"""Distributed writers. Each output is a directory of part files committed
atomically by Spark's file commit protocol (a failed or lost task never
leaves a half-written output that later counts as done); partition columns
replace the one-file-per-chromosome / per-sample / per-cell-type layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twasprep.functions.genotype import render_maf
from twasprep.operators.bundle import bundle_report
from twasprep.operators.genotype import sample_values
from twasprep.schemas import (
    EXPORT_KEY,
    MISSING_DOSAGE_TOKEN,
    SNP_ANNOTATION_COLUMNS,
)


# Text sinks write cells exactly as rendered: the CSV writer would otherwise
# trim leading/trailing whitespace (tabs included) of every value.
_RAW = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _nan_to_null(df: DataFrame) -> DataFrame:
    """Float NaN cells -> NULL so that they render as empty text cells."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _by_partition(writer, by_partition: bool):
    """With ``by_partition`` an overwrite replaces only the partitions that it writes."""
    return writer.option("partitionOverwriteMode", "dynamic") if by_partition else writer


def write_dosage_matrix(arrays: DataFrame, samples, path: str, mode: str = "errorifexists",
                        partition_by: str | list[str] | None = "chrom", by_partition: bool = False) -> None:
    """Genotype matrix text: header ``varID <samples>``, tab-separated,
    missing dosage ``.``; one directory per chromosome.

    Lines are built row-locally from the dosage array, so the plan keeps
    the same width whatever the number of samples; the header is written at
    the top of every part file.
    """
    from twasprep.operators.genotype import matrix_lines

    names = sample_values(samples)
    header = "\t".join(["varID", *names])
    lines = matrix_lines(arrays, missing=MISSING_DOSAGE_TOKEN, keep=_names(partition_by))
    write_lines_with_header(lines, header, path, partition_by=partition_by, mode=mode, by_partition=by_partition)


def _names(partition_by: str | list[str] | None) -> list[str]:
    return [partition_by] if isinstance(partition_by, str) else list(partition_by or [])


def write_variant_annotation(annotation: DataFrame, path: str, mode: str = "errorifexists",
                             partition_by: str | None = None) -> None:
    """Headerless ``varID chrom pos ref alt``, tab-separated; with ``partition_by``
    an overwrite replaces only the partitions that it writes."""
    cols = _names(partition_by)
    w = (annotation.select("varid", "chrom", F.col("pos").cast("string"), "ref", "alt", *cols)
         .write.mode(mode).option("sep", "\t").option("header", "false").options(**_RAW))
    _by_partition(w.partitionBy(*cols) if cols else w, bool(cols)).csv(path)


def snp_annotation_columns(snps: DataFrame, missing_maf: str = "NA") -> list:
    """The SNP annotation columns rendered as text (MAF printed like a Python
    float, ``missing_maf`` when undefined; R2 printed ``1.0``)."""
    maf = render_maf("MAF")
    if missing_maf != "NA":
        maf = F.when(F.col("MAF").isNull(), F.lit(missing_maf)).otherwise(maf)
    rendered = {
        "MAF": maf,
        # passed through: 1.0 where this library created it, else as it was read
        "R2": F.coalesce(F.col("R2").cast("string"), F.lit("NA")),
    }
    return [rendered.get(c, F.col(c).cast("string")).alias(c) for c in SNP_ANNOTATION_COLUMNS]


def snp_annotation_lines(snps: DataFrame, missing_maf: str = "NA") -> DataFrame:
    """``(varID, value)``: each SNP annotation row as its tab-separated line."""
    cols = snp_annotation_columns(snps, missing_maf)
    return snps.select(F.col("varID"), F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in cols])
                       .alias("value"))


def write_snp_annotation(snps: DataFrame, path: str, missing_maf: str = "NA",
                         mode: str = "errorifexists", partition_by: str | None = None,
                         by_partition: bool = False, src: str | None = None) -> None:
    """SNP annotation TSV with header (see ``snp_annotation_columns``).

    ``partition_by='chromosome'`` writes one directory per chromosome
    (``chromosome_part=<name>``, below ``<src>=<value>`` where that column is
    named); the files keep the chromosome column.
    """
    cols = snp_annotation_columns(snps, missing_maf)
    folders = [src] if src else []
    if src:
        cols.append(F.col(src))
    if partition_by:
        # a copy drives the directories so the files keep every column
        cols.append(F.col(partition_by).cast("string").alias(f"{partition_by}_part"))
        folders.append(f"{partition_by}_part")
    out = snps.select(*cols)
    w = (out.write.mode(mode).option("sep", "\t").option("header", "true").options(**_RAW)
         .option("nullValue", "").option("emptyValue", ""))
    _by_partition(w.partitionBy(*folders) if folders else w, by_partition).csv(path)


def write_lines_with_header(lines: DataFrame, header: str, path: str,
                            partition_by: str | list[str] | None = None, compression: str | None = None,
                            mode: str = "errorifexists", by_partition: bool = False) -> None:
    """Write pre-rendered text lines (column ``value``) with ``header`` as the
    first line of every part file.

    Uses the CSV writer over a single column named by the header; the field
    separator and quote character are set to control characters that never
    occur in the lines, so nothing is quoted or escaped.
    """
    folders = _names(partition_by)
    cols = [F.col("value").alias(header), *[F.col(c) for c in folders]]
    w = (lines.select(*cols).write.mode(mode).option("header", "true").options(**_RAW)
         .option("sep", "\u0001").option("quote", "").option("escape", "")
         .option("emptyValue", ""))
    if compression:
        w = w.option("compression", compression)
    _by_partition(w.partitionBy(*folders) if folders else w, by_partition).csv(path)


def write_lines_by_header(lines: DataFrame, path: str, partition_by: str,
                          compression: str | None = None, mode: str = "errorifexists") -> None:
    """Like ``write_lines_with_header`` for lines that bring their own ``header``:
    one distributed write per distinct header (files of a run share one or a few;
    only the distinct header lines reach the driver)."""
    headers = sorted(r.header for r in lines.select("header").distinct().collect())
    for i, header in enumerate(headers):
        write_lines_with_header(lines.where(F.col("header") == header), header, path,
                                partition_by=partition_by, compression=compression,
                                mode=mode if i == 0 else "append")


def _csv_number(x):
    return F.when(F.isnan(x), F.lit("")).otherwise(x.cast("string"))


def write_gene_features(features: DataFrame, path: str, fmt: str = "parquet",
                        mode: str = "errorifexists", width: int | None = None,
                        by_partition: bool = False) -> None:
    """Gene mean features per sample: Parquet partitioned by sample (arrays
    kept), or gzip CSV ``gene_name,0,1,...`` with a header (fmt='csv'; the
    header needs the vector ``width``)."""
    if fmt == "parquet":
        _by_partition(features.write.mode(mode).partitionBy("sample_id"), by_partition).parquet(path)
        return
    if width is None:
        raise ValueError("width is required for the CSV export header")
    header = ",".join(["gene_name", *[str(i) for i in range(width)]])
    text = features.select(
        "sample_id",
        F.concat_ws(",", F.col("gene_name"),
                    F.array_join(F.transform("features", _csv_number), ",")).alias("value"))
    write_lines_with_header(text, header, path, partition_by="sample_id", compression="gzip",
                            mode=mode)


def write_region_features(regions: DataFrame, path: str, fmt: str = "parquet",
                          mode: str = "errorifexists", width: int | None = None) -> None:
    """Region features per sample: Parquet, or CSV ``gene_name,0..n-1,chromo``
    (the region id under the historical ``gene_name`` header) with fmt='csv'."""
    if fmt == "parquet":
        regions.write.mode(mode).partitionBy("sample_id").parquet(path)
        return
    if width is None:
        raise ValueError("width is required for the CSV export header")
    header = ",".join(["gene_name", *[str(i) for i in range(width)], "chromo"])
    text = regions.select(
        "sample_id",
        F.concat_ws(",", F.col("region"),
                    F.array_join(F.transform("features", _csv_number), ","), F.col("chromo"))
        .alias("value"))
    write_lines_with_header(text, header, path, partition_by="sample_id", mode=mode)


def write_predictions(predictions: DataFrame, path: str, mode: str = "errorifexists",
                      compression: str | None = "gzip") -> None:
    """Per-sample prediction CSVs (wide or long), partitioned by sample."""
    w = _nan_to_null(predictions).write.mode(mode).option("header", "true").options(**_RAW)
    if compression:
        w = w.option("compression", compression)
    w.partitionBy("sample_id").csv(path)


def write_cell_type_matrices(matrix: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One gene x sample CSV directory per cell type; missing cells empty.
    A cell type without rows gets no directory."""
    (_nan_to_null(matrix).write.mode(mode).option("header", "true").options(**_RAW).option("nullValue", "")
     .partitionBy("cell_type").csv(path))


def write_predictdb_expression(expression: DataFrame, path: str, mode: str = "errorifexists",
                               partition_by: str | None = "cell_type") -> None:
    """PredictDB expression: tab-separated, gzip, header ``NAME <samples>``."""
    if EXPORT_KEY not in expression.columns:
        raise ValueError("expression must have its key column named NAME")
    w = (_nan_to_null(expression).write.mode(mode).option("sep", "\t").option("header", "true").options(**_RAW)
         .option("nullValue", "").option("compression", "gzip"))
    if partition_by and partition_by in expression.columns:
        w = w.partitionBy(partition_by)
    w.csv(path)


def export_bundle(spark: SparkSession, path: str, gene_annotation: DataFrame,
                  snp_annotation: DataFrame, genotype: DataFrame, expression: DataFrame,
                  mode: str = "errorifexists") -> DataFrame:
    """Write the four trainer inputs as Parquet and return ``bundle_report`` of what
    was written (see ``operators.bundle``)."""
    base, tables = path.rstrip("/"), {"gene_annotation": gene_annotation, "snp_annotation": snp_annotation,
                                      "genotype": genotype, "expression": expression}
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{base}/{name}")
    return bundle_report(**{name: spark.read.parquet(f"{base}/{name}") for name in tables})
