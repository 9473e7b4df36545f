"""Row positions of a group over several Parquet files, without moving the rows.

A file's rows carry their place in it (``_metadata.row_index``), whatever order
the scan takes the files in. A group's position is what its earlier files (in
name order) and the earlier stretches of its file hold, plus the place inside
the stretch: counts per (group, file, stretch) are added up, never a window over
a group's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a file that are counted together.
STRETCH = 2 ** 18
SOURCE = ("src_file", "src_row")


def read_with_source(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
                     reader=None) -> DataFrame:
    """Parquet rows with ``src_file`` (path) and ``src_row`` (place in the file)."""
    reader = spark.read if reader is None else reader
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    return df.select("*", F.col("_metadata.file_path").alias("src_file"),
                     F.col("_metadata.row_index").alias("src_row"))


def add_positions(rows: DataFrame, group: str = "sample_id", name: str = "ord") -> DataFrame:
    """``rows`` (with ``src_file``, ``src_row``) with the 0-based position of each
    row in its group: files in name order, rows in file order.

    Where a group's rows follow each other inside a stretch the position is
    arithmetic; only rows of stretches in which groups mix (or rows are missing)
    are ranked, on (group, file, row) alone. Both side tables join on few rows
    or none, so wide rows stay where they are. Groups are compared null-safely;
    a path is compared as it is written (percent-encoded).
    """
    stretch = F.floor(F.col("src_row") / STRETCH).cast("long")
    narrow = rows.select(F.col(group).alias("_g"), F.col("src_file").alias("_f"), F.col("src_row").alias("_r"),
                         stretch.alias("_s"))
    counts = narrow.groupBy("_g", "_f", "_s").agg(F.count(F.lit(1)).alias("_n"), F.min("_r").alias("_lo"),
                                                  F.max("_r").alias("_hi"))
    earlier = Window.partitionBy("_g").orderBy("_f", "_s").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    mixed = counts.where(F.col("_hi") - F.col("_lo") + 1 != F.col("_n")).select(
        F.col("_g").alias("_mg"), F.col("_f").alias("_mf"), F.col("_s").alias("_ms"))
    inside = Window.partitionBy("_g", "_f", "_s").orderBy("_r")
    ranks = (narrow.join(mixed, F.col("_g").eqNullSafe(F.col("_mg")) & (F.col("_f") == F.col("_mf"))
                         & (F.col("_s") == F.col("_ms")), "left_semi")
             .withColumn("_rank", (F.row_number().over(inside) - 1).cast("long"))
             .select(F.col("_f").alias("_rf"), F.col("_r").alias("_rr"), "_rank"))

    def same(f: Column, s: Column) -> Column:
        return F.col(group).eqNullSafe(F.col("_g")) & (F.col("src_file") == f) & (stretch == s)

    placed = rows.join(starts.drop("_hi", "_n"), same(F.col("_f"), F.col("_s"))).join(
        ranks, (F.col("src_file") == F.col("_rf")) & (F.col("src_row") == F.col("_rr")), "left")
    position = F.col("_before") + F.coalesce("_rank", F.col("src_row") - F.col("_lo"))
    return placed.select(*[F.col(c) for c in rows.columns if c != name], position.cast("long").alias(name))
