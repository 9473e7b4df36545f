"""Sequence-model feature operators: bin means and gene-window means.

Feature vectors stay one ``array<double>`` column end to end (thousands of
elements), never thousands of scalar columns. Element-wise means over a
group use ``Summarizer`` (a JVM vector aggregate with partial aggregation:
hot groups are combined map-side).
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twasprep.functions.vectors import elementwise_mean_of_rows
from twasprep.operators.common import keep_first


def bin_mean_vector(bins) -> "F.Column":
    """Mean over the bin axis of ``array<array<num>>``; NULL when the bins
    differ in length or are empty (the row is rejected)."""
    return elementwise_mean_of_rows(bins)


def region_bin_means(tensors: DataFrame, keep_rejects: bool = False) -> DataFrame:
    """``(sample_id, region, bins)`` -> ``(sample_id, region, chromo, features)``.

    Row-local (no shuffle). ``chromo`` is the region id before its first
    ``_``. Regions whose bins differ in length are dropped, or returned with
    a NULL vector when ``keep_rejects``. ``src_file`` and ``src_row`` pass through.
    """
    source = [c for c in ("src_file", "src_row") if c in tensors.columns]
    out = tensors.select(
        "sample_id", "region",
        F.substring_index("region", "_", 1).alias("chromo"),
        bin_mean_vector("bins").alias("features"), *source,
    )
    return out if keep_rejects else out.where(F.col("features").isNotNull())


def window_pairs(windows: DataFrame) -> DataFrame:
    """Gene windows -> distinct ``(gene_name, region)`` pairs.

    Windows with a NULL or empty region list are dropped; a region listed
    twice for one gene counts once.
    """
    valid = windows.where(F.col("region_names").isNotNull() & (F.col("region_names") != ""))
    return valid.select(
        "gene_name",
        F.explode(F.array_distinct(F.split("region_names", r"[|]"))).alias("region"),
    ).distinct()


def _vector_mean(col: str = "features"):
    return vector_to_array(Summarizer.mean(array_to_vector(F.col(col)))).alias(col)


def gene_region_means(windows: DataFrame, features: DataFrame,
                      chunk_rows: int | None = None) -> DataFrame:
    """Mean feature vector of each gene's regions, per sample.

    ``features``: sample_id, region, features (and ord, with ``chunk_rows``). Genes none of whose
    regions has a feature row are absent; duplicate feature rows of a region
    each count.

    ``chunk_rows`` reproduces the chunked legacy computation: rows are taken
    ``chunk_rows`` at a time in file order and a gene gets one mean per chunk
    that holds any of its regions (output gains ``chunk``).
    """
    pairs = window_pairs(windows)
    f = features.select("sample_id", "region", "features")
    keys = ["sample_id", "gene_name"]
    if chunk_rows is not None:
        f = features.select(*f.columns, F.floor(F.col("ord") / F.lit(chunk_rows)).cast("long").alias("chunk"))
        keys = ["sample_id", "chunk", "gene_name"]
    joined = f.join(pairs, "region")
    return joined.groupBy(*keys).agg(_vector_mean())


def first_chunk_means(windows: DataFrame, features: DataFrame, chunk_rows: int) -> DataFrame:
    """Chunked means followed by keep-first per gene: the mean over the
    regions found in the earliest chunk holding any of the gene's regions."""
    chunked = gene_region_means(windows, features, chunk_rows=chunk_rows)
    return keep_first(chunked, ["sample_id", "gene_name"], "chunk")
