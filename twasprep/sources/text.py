"""Line-oriented text scans with a stable per-file line number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def decoded_path() -> Column:
    """Path of a row's file as listings have it (the metadata path is percent-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_lines(spark: SparkSession, path: str | list[str], numbering: str = "dense",
               path_glob: str | None = None, keep_path=None) -> DataFrame:
    """``(file_path, line_no, value)`` for every line of every matched file.

    ``keep_path`` (file path column -> boolean column) leaves whole files out
    of the scan.

    ``numbering``:

    * ``"dense"`` - ``line_no`` is the 0-based position of the line in its
      file. Rows of one input split sit consecutively in one partition, so
      each split's row offset comes from ``monotonically_increasing_id``; a
      tiny per-split count table (one row per split) is prefix-summed per file
      and joined back by broadcast. This reads the text twice (count pass +
      data pass) and suits small and medium inputs.
    * ``"order"`` - single pass: ``line_no`` is a struct ``(block, row)``
      whose order is the file order (split byte offset, then position inside
      the split). Enough for "first record wins" / "last row wins"; used for
      genome-scale inputs whose headers are recognised by content.
    * ``"none"`` - no line column.
    """
    reader = spark.read
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    file_path = decoded_path()
    scan = reader.text(path)
    if keep_path is not None:
        scan = scan.where(keep_path(file_path))
    raw = scan.select(
        F.col("value"),
        file_path.alias("file_path"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    if numbering == "none":
        return raw.drop("_block")
    raw = raw.withColumn("_mid", F.monotonically_increasing_id())
    if numbering == "order":
        return raw.select("file_path",
                          F.struct(F.col("_block").alias("block"), F.col("_mid").alias("row"))
                          .alias("line_no"),
                          "value")
    if numbering != "dense":
        raise ValueError("numbering must be 'dense', 'order' or 'none'")
    splits = raw.groupBy("file_path", "_block").agg(
        F.min("_mid").alias("_mid0"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file_path").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    splits = splits.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (raw.join(F.broadcast(splits.drop("_n")), ["file_path", "_block"])
            .select("file_path",
                    (F.col("_off") + F.col("_mid") - F.col("_mid0")).alias("line_no"),
                    "value"))


def file_stem(path_col: Column | str, strip_suffix: str = r"\.[^/]*$") -> Column:
    """Base name of a path column with everything from the first dot removed."""
    col = F.col(path_col) if isinstance(path_col, str) else path_col
    base = F.regexp_extract(col, r"([^/]+)$", 1)
    return F.regexp_replace(base, strip_suffix, "")


def sample_from_path(path_col: Column | str, strip_suffix: str = r"\.[^/]*$",
                     partition_key: str = "sample_id") -> Column:
    """Sample id of a file: the ``<partition_key>=<id>`` directory when the
    file sits in one (outputs of the partitioned writers), else the file's
    base name with ``strip_suffix`` removed."""
    col = F.col(path_col) if isinstance(path_col, str) else path_col
    part_dir = F.regexp_extract(col, partition_key + r"=([^/]+)/[^/]*$", 1)
    return F.when(part_dir != "", part_dir).otherwise(file_stem(col, strip_suffix))


def read_sample_list(spark: SparkSession, path: str) -> DataFrame:
    """Scan a sample list (see ``parse_sample_list``)."""
    return parse_sample_list(read_lines(spark, path))


def parse_sample_list(lines: DataFrame) -> DataFrame:
    """``(ord int, sample_id)``: one id per non-blank line, order preserved."""
    return (lines.where(F.trim("value") != "")
            .select(F.trim("value").alias("sample_id"), "line_no")
            .select((F.dense_rank().over(Window.orderBy("line_no")) - 1).cast("int").alias("ord"),
                    "sample_id"))


def list_files(spark: SparkSession, path: str, path_glob: str | None = None,
               recursive: bool = False) -> DataFrame:
    """``(path, file_name, length)`` of matching files, without reading them
    (the ``binaryFile`` source only opens a file when ``content`` is used)."""
    reader = spark.read.format("binaryFile")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(path).select("path", "length")
    return df.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                     "length")


def discover_chromosomes(spark: SparkSession, path: str,
                         name_pattern: str = r"^chr([^_]+)_",
                         chromosomes: str = "all") -> DataFrame:
    """Chromosomes named by the files of a folder (``chr<X>_...``), or the
    given comma list, with their natural order (1, 2, ..., 10, ..., X)."""
    from twasprep.operators.genotype import chromosome_order

    if chromosomes.strip().lower() != "all":
        names = [c.strip() for c in chromosomes.split(",") if c.strip()]
        df = spark.createDataFrame([(c,) for c in names], "chromosome string")
    else:
        return chromosomes_of(list_files(spark, path), name_pattern)
    return chromosome_order(df, "chromosome")


def chromosomes_of(files: DataFrame, name_pattern: str = r"^chr([^_]+)_") -> DataFrame:
    """Chromosomes named by ``file_name`` of a listing, with their natural order."""
    from twasprep.operators.genotype import chromosome_order

    names = files.select(F.regexp_extract("file_name", name_pattern, 1).alias("chromosome"))
    return chromosome_order(names.where(F.col("chromosome") != ""), "chromosome")
