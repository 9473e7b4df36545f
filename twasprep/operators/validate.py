"""Matrix validation: shape and content checks in one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twasprep.sources.tables import HeaderedRows

CHECKS = ("has_gene_name", "all_numeric", "no_duplicate_columns", "no_missing_genes",
          "no_duplicate_genes")


def validate_matrix(df: DataFrame, key: str = "gene_name", group_by: Sequence[str] = (),
                    header: Sequence[str] | None = None, sample_rows: int | None = None,
                    order_col: str | None = None) -> DataFrame:
    """Shape (``n_samples``, ``n_genes``) and checks per group of a matrix.

    * has_gene_name: the key column exists;
    * all_numeric: every non-key cell is a number (NULL fails);
    * no_duplicate_columns: from the raw ``header`` when given;
    * no_missing_genes / no_duplicate_genes on the key.

    All rows are checked; ``sample_rows`` limits the content checks to the
    first rows of each group (by ``order_col``, else in scan order), as a quick
    look. ``n_genes`` counts every row in either case.
    """
    group_by = list(group_by)
    value_cols = [c for c in df.columns if c not in (key, *group_by)]
    names = list(header) if header is not None else list(df.columns)
    no_dup_cols = len(names) == len(set(names))
    has_key = key in df.columns
    data = df
    if sample_rows:
        by = F.col(order_col) if order_col else F.col("_pos")
        first = Window.partitionBy(*(group_by or [F.lit(0)])).orderBy(by)
        data = df if order_col else df.withColumn("_pos", F.monotonically_increasing_id())
        data = data.withColumn("_rank", F.row_number().over(first)).where(
            F.col("_rank") <= sample_rows)
    keycol = F.col(key) if has_key else F.lit(None).cast("string")
    bad_cells = F.exists(
        F.array(*[F.col(c).cast("string") for c in value_cols]) if value_cols
        else F.array().cast("array<string>"),
        lambda v: v.try_cast("double").isNull())
    per_gene = data.groupBy(*group_by, keycol.alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(bad_cells).alias("_bad"))
    agg = per_gene.groupBy(*group_by).agg(
        F.sum("_n").alias("n_genes"),
        F.sum("_bad").alias("_bad"),
        F.sum(F.when(F.col("_k").isNull(), F.col("_n")).otherwise(0)).alias("_nullk"),
        F.count_if(F.col("_k").isNotNull() & (F.col("_n") > 1)).alias("_dupk"),
    )
    if sample_rows:
        total = df.groupBy(*group_by).agg(F.count(F.lit(1)).alias("_all"))
        one = group_by or ["_one"]
        if not group_by:
            agg, total = agg.withColumn("_one", F.lit(1)), total.withColumn("_one", F.lit(1))
        agg = agg.join(total, one).withColumn("n_genes", F.col("_all"))
    return agg.select(
        *group_by,
        F.lit(len(value_cols)).cast("long").alias("n_samples"),
        F.col("n_genes").cast("long").alias("n_genes"),
        F.lit(has_key).alias("has_gene_name"),
        (F.col("_bad") == 0).alias("all_numeric"),
        F.lit(no_dup_cols).alias("no_duplicate_columns"),
        (F.col("_nullk") == 0).alias("no_missing_genes"),
        (F.col("_dupk") == 0).alias("no_duplicate_genes"),
    )


def validate_files(matrix: HeaderedRows, sample_rows: int | None = None) -> DataFrame:
    """The same shape and checks for cell-type matrix files, each by its own header.

    One row per cell type and header; cells are checked in the ``fields`` array,
    so a repeated column name is reported, and a row with more or fewer cells
    than its header is not numeric. A file without a header gives a row
    with every check False. ``sample_rows`` looks at the first rows of each file.
    """
    heads = matrix.headers.select("file_path", "cell_type", "names")
    rows = matrix.rows
    if sample_rows:
        first = Window.partitionBy("file_path").orderBy("line_no")
        rows = rows.withColumn("_looked", F.row_number().over(first) <= sample_rows)
    else:
        rows = rows.withColumn("_looked", F.lit(True))
    at = F.array_position("names", "gene_name")
    bad = (F.size("fields") != F.size("names")) | F.exists(
        F.transform("fields", lambda c, i: F.when(i + 1 != at, F.coalesce(
            c.try_cast("double").isNull(), F.lit(True))).otherwise(F.lit(False))), lambda b: b)
    gene = F.when(at > 0, F.try_element_at("fields", at.cast("int")))
    j = rows.join(heads, "file_path").select(
        "cell_type", "names", F.when(gene != "", gene).alias("_k"),
        F.col("_looked").cast("int").alias("_l"), (bad & F.col("_looked")).cast("int").alias("_bad"))
    per_gene = j.groupBy("cell_type", "names", "_k").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_l").alias("_l"), F.sum("_bad").alias("_bad"))
    agg = per_gene.groupBy("cell_type", "names").agg(
        F.sum("_n").alias("_n"), F.sum("_bad").alias("_bad"),
        F.sum(F.when(F.col("_k").isNull(), F.col("_l")).otherwise(0)).alias("_nullk"),
        F.count_if(F.col("_k").isNotNull() & (F.col("_l") > 1)).alias("_dupk"))
    # headers without rows and files without a header keep a row
    out = heads.select("cell_type", "names").distinct().join(
        agg.withColumnRenamed("names", "_names").withColumnRenamed("cell_type", "_ct"),
        (F.col("cell_type") == F.col("_ct")) & (F.col("names") == F.col("_names")), "left")
    read = F.col("names").isNotNull()
    none = lambda c: read & (F.coalesce(F.col(c), F.lit(0)) == 0)
    return out.select(
        "cell_type",
        F.when(read, F.size("names") - 1).otherwise(0).cast("long").alias("n_samples"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_genes"),
        (read & F.coalesce(F.array_contains("names", "gene_name"), F.lit(False)))
        .alias("has_gene_name"),
        none("_bad").alias("all_numeric"),
        (read & F.coalesce(F.size(F.array_distinct("names")) == F.size("names"), F.lit(False)))
        .alias("no_duplicate_columns"),
        none("_nullk").alias("no_missing_genes"),
        none("_dupk").alias("no_duplicate_genes"))


def validation_report(checks: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """``validate_matrix`` output as rows ``(<group>, check, passed, detail)``;
    ``detail`` carries the matrix shape."""
    group_by = list(group_by)
    detail = F.format_string("%d samples, %d genes", F.col("n_samples"), F.col("n_genes"))
    return checks.select(*group_by, detail.alias("detail"), *CHECKS).unpivot(
        [*group_by, "detail"], list(CHECKS), "check", "passed"
    ).select(*group_by, "check", "passed", "detail")
