"""VCF text scan (plain or bgzip) into a variant table plus sample headers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twasprep.sources.bgzip import read_gzip_lines
from twasprep.sources.text import list_files, read_lines


@dataclass(frozen=True)
class VcfTable:
    """``records``: one row per variant line; ``headers``: one row per file.

    records: file_path, line_no, chrom, pos, id, ref, alt, format, cells
    headers: file_path, sample_names (array<string>, header order)
    """

    records: DataFrame
    headers: DataFrame


def parse_vcf(lines: DataFrame) -> VcfTable:
    """Split VCF lines (``file_path, line_no, value``) into records and headers.

    Meta lines (``##``) are dropped; the ``#CHROM`` line of each file gives its
    sample names (columns 10..n). Records keep the raw sample cells as an
    array so that sample selection stays row-local.
    """
    header = (lines.where(F.col("value").startswith("#CHROM"))
              .select("file_path", F.split("value", "\t").alias("f"))
              .select("file_path",
                      F.when(F.size("f") > 9, F.slice("f", 10, F.size("f") - 9))
                      .otherwise(F.array().cast("array<string>")).alias("sample_names")))
    body = lines.where(~F.col("value").startswith("#") & (F.length("value") > 0))
    f = F.split("value", "\t")
    records = body.select(
        "file_path",
        "line_no",
        F.try_element_at(f, F.lit(1)).alias("chrom"),
        F.try_element_at(f, F.lit(2)).try_cast("long").alias("pos"),
        F.try_element_at(f, F.lit(3)).alias("id"),
        F.try_element_at(f, F.lit(4)).alias("ref"),
        F.try_element_at(f, F.lit(5)).alias("alt"),
        F.try_element_at(f, F.lit(9)).alias("format"),
        F.when(F.size(f) > 9, F.slice(f, 10, F.size(f) - 9))
        .otherwise(F.array().cast("array<string>")).alias("cells"),
    )
    return VcfTable(records=records, headers=header)


def read_vcf(spark: SparkSession, path: str | list[str], path_glob: str | None = None,
             numbering: str = "order", split_gzip: bool = False) -> VcfTable:
    """Scan VCF files in one pass (headers are recognised by content, records
    keep a file-order key). The text scan takes one task per gzip file;
    ``split_gzip`` reads block-gzip files by ranges, several tasks each (see
    ``sources.bgzip``), and needs paths that ``pyarrow.fs`` can open."""
    if split_gzip:
        files = list_files(spark, path, path_glob, recursive=True).where(
            F.col("file_name").rlike(r"\.(gz|bgz)$"))
        return parse_vcf(read_gzip_lines(spark, sorted(r.path for r in files.select("path").collect())))
    return parse_vcf(read_lines(spark, path, numbering=numbering, path_glob=path_glob))
