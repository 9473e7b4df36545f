"""A ledger of written text files: what was written can be checked later.

``file_ledger`` records every part file (path, header line, data rows, bytes and
their SHA-256, read through ``binaryFile``, one part file in a task at a time);
``changed_files`` compares a folder with its ledger. ``text_digest`` describes the
text of a folder whatever its part files are: per partition value the header, the
rows and an order-free checksum of the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twasprep.sources.text import read_lines


def line_hash(value: Column) -> Column:
    """28 bits of md5 of a line (sums of them stay exact in a long)."""
    return F.conv(F.substring(F.md5(value), 1, 7), 16, 10).cast("long")


def _text(spark: SparkSession, path: str, header: bool) -> DataFrame:
    """file_path, header (of the file, null where it has none), lines, checksum."""
    lines = read_lines(spark, path, numbering="order")
    first = F.min_by("value", "line_no")
    per_file = lines.groupBy("file_path").agg(first.alias("first"), F.count(F.lit(1)).alias("n"),
                                              F.sum(line_hash(F.col("value"))).alias("sum"))
    if not header:
        return per_file.select("file_path", F.lit(None).cast("string").alias("header"), F.col("n").alias("rows"),
                               F.col("sum").alias("checksum"))
    return per_file.select("file_path", F.col("first").alias("header"), (F.col("n") - 1).alias("rows"),
                           (F.col("sum") - line_hash(F.col("first"))).alias("checksum"))


def text_digest(spark: SparkSession, path: str, partition: str | None = None, header: bool = True) -> DataFrame:
    """``(part, header, rows, checksum)`` per value of the ``partition`` folders
    ('' without them); part files with different headers are told apart."""
    part = F.regexp_extract("file_path", f"/{partition}=([^/]+)/", 1) if partition else F.lit("")
    return _text(spark, path, header).groupBy(part.alias("part"), "header").agg(
        F.sum("rows").alias("rows"), F.sum("checksum").alias("checksum"))


def file_ledger(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``(path, header, rows, length, sha256)`` of every part file below ``path``."""
    bytes_of = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                .where(F.col("path").rlike(r"/part-[^/]*$"))
                .select("path", "length", F.sha2("content", 256).alias("sha256")))
    text = _text(spark, path, header).select(F.col("file_path").alias("path"), "header", "rows")
    plain = lambda df: df.withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    return plain(bytes_of).join(plain(text), "path", "left").select(
        "path", "header", F.coalesce("rows", F.lit(0)).alias("rows"), "length", "sha256")


def changed_files(ledger: DataFrame, now: DataFrame) -> DataFrame:
    """``(path, change)``: files that are missing, new, or of other bytes."""
    a = ledger.select("path", F.col("sha256").alias("was"), F.col("rows").alias("rows_was"))
    b = now.select("path", F.col("sha256").alias("is"), F.col("rows").alias("rows_is"))
    both = a.join(b, "path", "full")
    change = (F.when(F.col("is").isNull(), "missing").when(F.col("was").isNull(), "new")
              .when((F.col("was") != F.col("is")) | (F.col("rows_was") != F.col("rows_is")), "changed"))
    return both.select("path", change.alias("change")).where("change is not null")
