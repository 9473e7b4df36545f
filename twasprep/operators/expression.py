"""Predicted expression reshaping and export keyed by Ensembl id.

Wide per-sample prediction tables are unpivoted once into the long layout
``(sample_id, gene_name, cell_type, prediction)``; every cell-type matrix
is a pivot of that one table (one shuffle for all cell types).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twasprep.functions.vectors import place_by_position
from twasprep.operators.common import last_wins
from twasprep.schemas import (
    CELL_TYPES,
    EXPORT_KEY,
    LEGACY_OUTPUT_SUFFIX,
    RENAMED_SUFFIX,
)
from twasprep.sources.tables import HeaderedRows


def rename_map(cell_types: Sequence[str] = CELL_TYPES) -> dict[str, str]:
    """Legacy long model-output names -> ``{ct}_predicted``."""
    return {f"{ct}{LEGACY_OUTPUT_SUFFIX}": f"{ct}{RENAMED_SUFFIX}" for ct in cell_types}


def rename_predictions(df: DataFrame, cell_types: Sequence[str] = CELL_TYPES) -> DataFrame:
    """Rename the legacy prediction columns; names not present are ignored."""
    return df.withColumnsRenamed(rename_map(cell_types))


def rename_headers(files: HeaderedRows, cell_types: Sequence[str] = CELL_TYPES) -> HeaderedRows:
    """The same on text files: only the header names change, per file; rows stay
    as they are (repeated genes, other columns and the cells' text included)."""
    new = F.create_map(*[F.lit(x) for kv in rename_map(cell_types).items() for x in kv])
    names = F.transform("names", lambda n: F.coalesce(F.try_element_at(new, n), n))
    return HeaderedRows(rows=files.rows, headers=files.headers.withColumn("names", names))


def csv_lines(files: HeaderedRows) -> DataFrame:
    """``sample_id, line_no, header, value``: rows as text beside their file's header."""
    heads = files.headers.select("file_path", "sample_id", F.array_join("names", ",").alias("header"))
    return files.rows.join(heads, "file_path").select(
        "sample_id", "line_no", "header", F.array_join("fields", ",").alias("value"))


def gene_key(df: DataFrame, key: str = "gene_name") -> DataFrame:
    """Use ``gene_name`` when present, else the first column, as the gene key."""
    if key in df.columns:
        return df
    return df.withColumnRenamed(df.columns[0], key)


def predictions_long(wide: DataFrame, cell_types: Sequence[str] = CELL_TYPES,
                     suffix: str = RENAMED_SUFFIX, ids: Sequence[str] = ("sample_id", "gene_name"),
                     ) -> DataFrame:
    """Wide (one column per cell type) -> long; cell types whose column is
    absent are skipped. NULL predictions are kept (they become empty cells)."""
    present = [ct for ct in cell_types if f"{ct}{suffix}" in wide.columns]
    if not present:
        return wide.select(*ids, F.lit(None).cast("string").alias("cell_type"),
                           F.lit(None).cast("double").alias("prediction")).limit(0)
    renamed = wide.select(*ids, *[F.col(f"{ct}{suffix}").cast("double").alias(ct) for ct in present])
    return renamed.unpivot(list(ids), present, "cell_type", "prediction")


def missing_cell_types(wide_files: HeaderedRows, cell_types: Sequence[str] = CELL_TYPES,
                       suffix: str = RENAMED_SUFFIX) -> DataFrame:
    """(sample_id, cell_type) pairs whose column is absent from the file."""
    want = F.array(*[F.lit(ct) for ct in cell_types])
    h = wide_files.headers.select("sample_id", "names", F.explode(want).alias("cell_type"))
    return (h.where(~F.array_contains("names", F.concat("cell_type", F.lit(suffix))))
            .select("sample_id", "cell_type"))


def predictions_long_from_files(files: HeaderedRows, cell_types: Sequence[str] = CELL_TYPES,
                                suffix: str = RENAMED_SUFFIX) -> DataFrame:  # noqa: E501
    """Per-sample prediction CSVs -> long, in one row-local pass.

    Columns are located per file by header name: the gene key is
    ``gene_name`` or else the first column; a cell type whose column is
    absent from a file yields no rows for that file. ``ord`` = line number
    (later rows of a gene win downstream).
    """
    h = files.headers
    key_pos = F.when(F.array_position("names", "gene_name") > 0,
                     F.array_position("names", "gene_name")).otherwise(F.lit(1))
    wanted = F.array(*[F.struct(F.lit(ct).alias("ct"),
                                F.array_position("names", f"{ct}{suffix}").alias("p"))
                       for ct in cell_types])
    hdr = h.select("file_path", "sample_id", key_pos.alias("kp"),
                   F.filter(wanted, lambda s: s["p"] > 0).alias("cts"))
    j = files.rows.join(F.broadcast(hdr), "file_path")
    e = j.select("sample_id", F.element_at("fields", F.col("kp").cast("int")).alias("gene_name"),
                 "line_no", "fields", F.explode("cts").alias("c"))
    return e.select(
        "sample_id", "gene_name", F.col("c.ct").alias("cell_type"),
        F.try_element_at("fields", F.col("c.p").cast("int")).try_cast("double").alias("prediction"),
        F.col("line_no").alias("ord"),
    )


def cell_type_matrix(long: DataFrame, samples: Sequence[str], order_col: str | None = None
                     ) -> DataFrame:
    """Long -> ``cell_type, gene_name, <samples sorted by name>``.

    ``samples`` are the discovered samples (all become columns, also those
    without any row: NULL). With ``order_col`` a repeated (sample, gene,
    cell type) keeps its last value, without it the largest. A cell type without
    rows yields no rows.
    """
    cols = sorted(samples)
    if order_col is not None:
        long = last_wins(long.select("cell_type", "gene_name", "sample_id", "prediction", order_col),
                         ["cell_type", "gene_name", "sample_id"], order_col)
    return (long.groupBy("cell_type", "gene_name").pivot("sample_id", cols)
            .agg(F.max("prediction")))


# Name used by the file-level API (one matrix per cell type).
def cell_type_matrices(long: DataFrame, samples: Sequence[str], order_col: str | None = None
                       ) -> DataFrame:
    """All cell-type matrices at once (alias of ``cell_type_matrix``)."""
    return cell_type_matrix(long, samples, order_col)


def cell_type_matrix_lines(long: DataFrame, samples: Sequence[str], sep: str = ",",
                           order_col: str | None = None) -> DataFrame:
    """Text rows of every cell-type matrix without a column per sample:
    ``cell_type, value`` where value = gene then the sorted samples' cells
    (empty when missing); a repeated key is settled as in
    ``cell_type_matrix``. Work and plan grow linearly with the samples."""
    cols = sorted(samples)
    keys = ["cell_type", "gene_name", "sample_id"]
    if order_col is not None:
        long = last_wins(long.select(*keys, "prediction", order_col), keys, order_col)
    else:
        # one value per (cell type, gene, sample) before gathering a gene's row
        long = long.groupBy(*keys).agg(F.max("prediction").alias("prediction"))
    # the sample's column number instead of one literal per sample in the plan
    listed = long.sparkSession.createDataFrame(list(enumerate(cols)), "ord int, sample_id string")
    entry = F.struct("ord", F.col("prediction").alias("value"))
    per_gene = long.select(*keys, "prediction").join(listed, "sample_id", "left").groupBy("cell_type", "gene_name").agg(
        F.collect_list(F.when(F.col("ord").isNotNull(), entry)).alias("_e"))
    cells = F.transform(place_by_position(F.col("_e"), len(cols)),
                        lambda v: F.coalesce(v.cast("string"), F.lit("")))
    return per_gene.select("cell_type", F.concat_ws(sep, "gene_name", F.array_join(cells, sep))
                           .alias("value"))


def gene_id_map(gene_annotation: DataFrame) -> DataFrame:
    """``gene_name -> ensembl_id``; a gene defined twice keeps its last row."""
    return last_wins(gene_annotation.select("gene_name", "ensembl_id", "ord"),
                     ["gene_name"], "ord").drop("ord")


def to_predictdb_expression(matrix: DataFrame, gene_annotation: DataFrame,
                            key: str = "gene_name") -> DataFrame:
    """Replace the gene key by its Ensembl id (kept when unmapped), named NAME.

    Rows are never merged: two genes mapping to one id stay two rows.
    """
    m = gene_id_map(gene_annotation)
    j = matrix.join(m, matrix[key] == m["gene_name"], "left") if key != "gene_name" \
        else matrix.join(m, "gene_name", "left")
    others = [c for c in matrix.columns if c != key]
    return j.select(F.coalesce(F.col("ensembl_id"), matrix[key]).alias(EXPORT_KEY),
                    *[matrix[c] for c in others])


def unmapped_summary(unmapped: DataFrame, examples: int = 5, all_below: int = 10,
                     key: str = "gene_name") -> DataFrame:
    """One row: the number of distinct unmapped genes and some of them (all
    when fewer than ``all_below``, else the first ``examples`` by name).

    Only ``all_below`` names are ever gathered (a top-n), never the set.
    """
    counted = unmapped.agg(F.count(F.lit(1)).alias("n_unmapped"),
                           F.lit(None).cast("array<string>").alias("_l"))
    shown = (unmapped.select(F.col(key).cast("string").alias(key)).orderBy(key).limit(all_below)
             .agg(F.lit(None).cast("long").alias("n_unmapped"),
                  F.sort_array(F.collect_list(key)).alias("_l")))
    both = counted.unionByName(shown).agg(F.max("n_unmapped").alias("n_unmapped"),
                                          F.max("_l").alias("_l"))
    return both.select(
        "n_unmapped",
        F.array_join(F.when(F.col("n_unmapped") < all_below, F.col("_l"))
                     .otherwise(F.slice("_l", 1, examples)), ",").alias("examples"))


def unmapped_genes(matrix: DataFrame, gene_annotation: DataFrame, key: str = "gene_name"
                   ) -> DataFrame:
    """Distinct gene keys of the matrix without an Ensembl id."""
    m = gene_id_map(gene_annotation).select(F.col("gene_name").alias("_g"))
    keys = matrix.select(F.col(key).alias("gene_name")).distinct()
    return keys.join(m, keys["gene_name"] == m["_g"], "left_anti")
