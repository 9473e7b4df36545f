"""Gene features -> per-sample z-scores -> one prediction per cell type.

Statistics are per sample (every sample is normalised on its own genes),
computed with ``Summarizer`` (partial aggregation, so one very large sample
is combined map-side) and joined back on ``sample_id``; the statistics side
has one vector row per sample and AQE broadcasts it from its measured size.

Scoring: a linear model set (one unit per cell type) is evaluated inside
the JVM as dot products against a literal weight array. Any other layer
stack is the one Python step: ``mapInPandas`` hands Arrow batches of
feature vectors to a NumPy scorer that evaluates every cell-type model on
the batch at once and emits the long ``(sample, gene, cell_type,
prediction)`` rows. Model weights travel inside the pickled function, which
PySpark ships as a broadcast variable once it is large.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twasprep.functions.vectors import array_dot, zscore_array
from twasprep.operators.common import keep_first
from twasprep.schemas import (
    CELL_TYPES,
    MODEL_FILE_MARKER,
    MODEL_OUTPUT_SUFFIX,
    PREDICTIONS_LONG,
    ZSCORE_EPSILON,
)

def keep_first_gene(features: DataFrame, keys: Sequence[str] = ("sample_id", "gene_name"),
                    order_col: str = "ord") -> DataFrame:
    """Drop repeated genes within a sample, keeping the first in file order."""
    return keep_first(features, list(keys), order_col)


def duplicate_report(features: DataFrame, keys: Sequence[str] = ("sample_id", "gene_name")
                     ) -> DataFrame:
    """Keys that occur more than once, with their row count (``n_rows``)."""
    return (features.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def feature_stats(features: DataFrame, key: str = "sample_id") -> DataFrame:
    """Per-sample element-wise mean and sample standard deviation.

    ``n_genes`` is the row count; with a single gene the standard deviation
    is undefined and set to NaN (an unbiased std of one value).
    """
    vec = array_to_vector(F.col("features"))
    s = features.groupBy(key).agg(
        Summarizer.metrics("mean", "std", "count").summary(vec).alias("_s"))
    std = vector_to_array(F.col("_s.std"))
    return s.select(
        key,
        vector_to_array(F.col("_s.mean")).alias("mean"),
        F.when(F.col("_s.count") > 1, std)
        .otherwise(F.transform(std, lambda _: F.lit(float("nan")))).alias("std"),
        F.col("_s.count").alias("n_genes"),
    )


def zscore_features(features: DataFrame, epsilon: float = ZSCORE_EPSILON,
                    dedupe: bool = True) -> DataFrame:
    """``(x - mean) / (std + epsilon)`` per feature, statistics per sample.

    Duplicate genes are dropped first (keep first), so the statistics see
    each gene once.
    """
    base = keep_first_gene(features) if dedupe else features
    # The statistics are derived from the whole feature table, so their size
    # is only known once computed: AQE broadcasts them when the aggregated
    # side is small at run time (one vector pair per sample) and keeps the
    # sort-merge join otherwise. A static count here would cost a second
    # pass over the features.
    # Joining on a hash of the key as well keeps both inputs on plain join
    # shuffles (the statistics are an aggregate on sample_id), the shape in
    # which AQE can split one very large sample across tasks.
    base = base.withColumn("sample_id", F.col("sample_id").cast("string"))
    stats = feature_stats(base).withColumn("_h", F.xxhash64("sample_id"))
    j = base.withColumn("_h", F.xxhash64("sample_id")).join(stats, ["sample_id", "_h"])
    return j.select("sample_id", "gene_name",
                    zscore_array("features", "mean", "std", epsilon).alias("features"))


def first_gene_rows(features: DataFrame) -> DataFrame:
    """(sample_id, part, firsts): per layout key a map from the genes that repeat to
    their least ``ord``, from the keys alone (``features`` is a ``bucket_features``
    table, whose buckets hold all rows of a gene: no exchange). A part holds a
    fixed share of a genome's genes, which bounds the map."""
    per_gene = features.groupBy("sample_id", "part", _gene_key().alias("_gene")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("ord").alias("_first"))
    entry = F.when(F.col("_n") > 1, F.struct("_gene", "_first"))
    return per_gene.groupBy("sample_id", "part").agg(F.map_from_entries(F.collect_list(entry)).alias("firsts"))


def _gene_key():
    """A map key for any gene, also one without a name."""
    return F.coalesce(F.concat(F.lit("="), F.col("gene_name")), F.lit("-"))


def zscore_bucketed(features: DataFrame, parts: int, epsilon: float = ZSCORE_EPSILON) -> DataFrame:
    """``zscore_features`` of a ``bucket_features`` table, its vectors never exchanged.

    Repeated genes are told by their keys inside the buckets; per-sample sums are
    partial vector aggregates (one vector pair per task and sample); the statistics
    come back to every part of their sample, on the keys the table is laid out by.
    Rows of one gene with equal ``ord`` all stay, so ``ord`` must tell rows apart."""
    first = F.coalesce(F.try_element_at("firsts", _gene_key()), F.col("ord"))
    base = features.join(first_gene_rows(features), ["sample_id", "part"]).where(F.col("ord") == first).select(
        "sample_id", "part", "gene_name", "features")
    stats = feature_stats(base).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return base.join(stats, ["sample_id", "part"]).select(
        "sample_id", "gene_name", zscore_array("features", "mean", "std", epsilon).alias("features"))


# ---------------------------------------------------------------------------
# Scorers
# ---------------------------------------------------------------------------
class Scorer(Protocol):
    """A model set: ``score`` maps an (n, d) batch to (n, len(cell_types))."""

    cell_types: Sequence[str]

    def score(self, x: np.ndarray) -> np.ndarray: ...


class DenseStackScorer:
    """Per cell type a stack of dense layers ``h = W h + b`` with ReLU between
    layers and an optional output activation. The last layer must have exactly
    one unit: a model with more would lose outputs, so it is refused."""

    def __init__(self, layers: dict[str, list[tuple[np.ndarray, np.ndarray]]],
                 output_activation: str | None = None):
        self.cell_types = list(layers)
        self.layers = {ct: [(np.asarray(w, dtype=np.float64), np.asarray(b, dtype=np.float64))
                            for w, b in ls] for ct, ls in layers.items()}
        self.output_activation = output_activation
        for ct, ls in self.layers.items():
            if not ls or ls[-1][0].shape[0] != 1:
                raise ValueError(f"model {ct!r} must end in one output unit")
        linear = all(len(ls) == 1 and ls[0][0].shape[0] == 1 for ls in self.layers.values())
        # All single-unit linear models: one stacked matmul for every cell type.
        self._stacked = None
        if linear and self.cell_types:
            w = np.vstack([self.layers[ct][0][0] for ct in self.cell_types])
            b = np.concatenate([self.layers[ct][0][1] for ct in self.cell_types])
            self._stacked = (w, b)

    def _activate(self, y: np.ndarray) -> np.ndarray:
        if self.output_activation == "sigmoid":
            return 1.0 / (1.0 + np.exp(-y))
        return y

    def linear_weights(self, width: int | None = None):
        """(W [models x width], b [models]) when every model is one linear
        unit (of the given width, if one is given), else None."""
        if self._stacked is None or self.output_activation is not None:
            return None
        if width is not None and self._stacked[0].shape[1] != width:
            return None
        return self._stacked

    def score(self, x: np.ndarray) -> np.ndarray:
        if self._stacked is not None:
            w, b = self._stacked
            return self._activate(x @ w.T + b)
        out = np.empty((x.shape[0], len(self.cell_types)))
        for k, ct in enumerate(self.cell_types):
            h = x
            stack = self.layers[ct]
            for depth, (w, b) in enumerate(stack):
                h = h @ w.T + b
                if depth < len(stack) - 1:
                    h = np.maximum(h, 0.0)
            out[:, k] = self._activate(h)[:, 0]
        return out

    @classmethod
    def from_weights_table(cls, models: DataFrame, output_activation: str | None = None
                           ) -> "DenseStackScorer":
        """Build from a ``(cell_type, layer, weights, bias)`` table.

        The table holds model parameters (bounded by the model size, not by
        the data) and is read once on the driver.
        """
        layers: dict[str, list] = {}
        for row in models.orderBy("cell_type", "layer").collect():
            layers.setdefault(row.cell_type, []).append(
                (np.asarray(row.weights, dtype=np.float64), np.asarray(row.bias, dtype=np.float64)))
        return cls(layers, output_activation)


class RuleLinearScorer:
    """Deterministic linear model set used where no trained weights exist:
    weight ``i`` of cell type ``k`` is ``((7 i + 3 k) mod 11 - 5) / 10`` and the
    bias is ``(k - 5) / 10``. Weights are generated for the batch width."""

    def __init__(self, cell_types: Sequence[str] = CELL_TYPES):
        self.cell_types = list(cell_types)

    def weight_expr(self, k: int, i) -> "F.Column":
        """Weight ``i`` of model ``k`` as a column expression (same rule)."""
        return (((i * 7 + 3 * k) % 11) - 5).cast("double") / F.lit(10.0)

    def bias_of(self, k: int) -> float:
        return (k - 5) / 10.0

    def linear_weights(self, width: int | None = None):
        if width is None:
            return None
        i = np.arange(width)[None, :]
        k = np.arange(len(self.cell_types))[:, None]
        w = (((7 * i + 3 * k) % 11) - 5) / 10.0
        b = (np.arange(len(self.cell_types)) - 5) / 10.0
        return w, b

    def score(self, x: np.ndarray) -> np.ndarray:
        w, b = self.linear_weights(x.shape[1])
        return x @ w.T + b


def _predict_rule_native(features: DataFrame, scorer) -> DataFrame:
    """Rule-defined linear models scored in the JVM: weights are generated
    per row from the rule and the row's width, then dotted with the row."""
    cts = list(scorer.cell_types)
    models = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(ct).alias("cell_type"))
                       for k, ct in enumerate(cts)])
    e = features.select("sample_id", "gene_name", "features", F.explode(models).alias("m"))
    def weights_of(k: int):
        # a one-argument lambda: transform() reads a second parameter as the index
        return F.transform(F.sequence(F.lit(0), F.size("features") - 1),
                           lambda i: scorer.weight_expr(k, i))

    # one expression per model index keeps k a literal inside the rule
    pred = None
    for k in range(len(cts)):
        val = array_dot("features", weights_of(k)) + F.lit(scorer.bias_of(k))
        pred = (F.when(F.col("m.k") == k, val) if pred is None
                else pred.when(F.col("m.k") == k, val))
    return e.select("sample_id", "gene_name", F.col("m.cell_type").alias("cell_type"),
                    pred.alias("prediction"))


def predict_expression_native(features: DataFrame, cell_types: Sequence[str],
                              weights: np.ndarray, bias: np.ndarray) -> DataFrame:
    """Linear model set scored inside the JVM.

    The models travel as one literal ``array<struct<cell_type, w, b>>``; each
    gene row is exploded over it and scored with ``aggregate(zip_with(x, w))``
    -- no Python worker and no Arrow transfer, but interpreted: the batched
    matrix product of ``engine="python"`` is faster on wide vectors. A vector
    of another width than the models' is an error.
    """
    width = np.asarray(weights).shape[1]
    fits = F.when(F.size("features") == width, F.col("features")).otherwise(
        F.raise_error(F.format_string("feature vector of width %d, models expect %d",
                                      F.size("features"), F.lit(width)))
        .cast("array<double>"))
    features = features.withColumn("features", fits)
    # one array Literal per model (a numpy array becomes a single plan node)
    lit_models = F.array(*[
        F.struct(F.lit(ct).alias("cell_type"),
                 F.lit(np.asarray(weights[k], dtype=np.float64)).alias("w"),
                 F.lit(float(bias[k])).alias("b"))
        for k, ct in enumerate(cell_types)])
    e = features.select("sample_id", "gene_name", "features", F.explode(lit_models).alias("m"))
    return e.select("sample_id", "gene_name", F.col("m.cell_type").alias("cell_type"),
                    (array_dot("features", "m.w") + F.col("m.b")).alias("prediction"))


def predict_expression(features: DataFrame, scorer: Scorer, engine: str = "auto") -> DataFrame:
    """Score every gene row with every cell-type model -> long predictions.

    ``features``: sample_id, gene_name, features (already normalised). The
    output has exactly ``rows x models`` rows; a batch that does not is an
    error (row conservation).

    ``engine``: ``"native"`` scores linear model sets inside the JVM,
    ``"python"`` uses Arrow batches and one matrix product per batch (any layer
    stack); ``"auto"`` takes the latter, but for rule-defined models, whose
    weights exist only as an expression.
    """
    cell_types = list(scorer.cell_types)
    n_models = len(cell_types)
    if engine in ("auto", "native"):
        # no data is read here: fixed-width weights come from the models, a
        # rule-based set builds its weights from each row's vector width
        lw = scorer.linear_weights() if hasattr(scorer, "linear_weights") else None
        if lw is not None and engine == "native":
            return predict_expression_native(features, cell_types, lw[0], lw[1])
        if hasattr(scorer, "weight_expr"):
            return _predict_rule_native(features, scorer)
        if engine == "native":
            raise ValueError("scorer is not a linear model set")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.vstack(pdf["features"].to_numpy()).astype(np.float64, copy=False)
            y = np.asarray(scorer.score(x), dtype=np.float64).reshape(len(pdf), n_models)
            out = pd.DataFrame({
                "sample_id": np.repeat(pdf["sample_id"].to_numpy(), n_models),
                "gene_name": np.repeat(pdf["gene_name"].to_numpy(), n_models),
                "cell_type": np.tile(np.asarray(cell_types, dtype=object), len(pdf)),
                "prediction": y.reshape(-1),
            })
            if len(out) != len(pdf) * n_models:
                raise ValueError("prediction rows do not match input rows x models")
            yield out

    return features.select("sample_id", "gene_name", "features").mapInPandas(
        run, PREDICTIONS_LONG)


def read_model_weights(spark, path: str) -> DataFrame:
    """Model-set table ``(cell_type, layer, weights, bias)`` from Parquet.

    Files may instead be named ``<cell_type><MODEL_FILE_MARKER>...``: a
    missing ``cell_type`` column is then taken from the file name.
    """
    df = spark.read.parquet(path)
    if "cell_type" not in df.columns:
        # ".../<cell_type><marker>[.ext][/part-file]"
        pattern = r"([^/]+?)" + re.escape(MODEL_FILE_MARKER) + r"[^/]*(/[^/]*)?$"
        df = df.withColumn("cell_type", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))
    return df.select("cell_type", F.col("layer").cast("int"), "weights", "bias")


def distinct_genes(features: DataFrame) -> DataFrame:
    """(sample_id, genes): distinct genes of each sample, from the keys alone."""
    return features.select(F.col("sample_id").cast("string").alias("sample_id"), "gene_name").distinct() \
        .groupBy("sample_id").agg(F.count(F.lit(1)).alias("genes"))


def row_conservation(genes: DataFrame, predictions: DataFrame, n_models: int) -> DataFrame:
    """Per sample: (sample_id, genes, predictions, conserved).

    ``genes``: (sample_id, genes) expected (a missing sample: 0); ``predictions``:
    the long rows written. A sample is conserved when it has genes x models rows."""
    rows = predictions.groupBy("sample_id").agg(F.count(F.lit(1)).alias("predictions"))
    zero = F.lit(0).cast("long")
    both = genes.join(rows, "sample_id", "full").select(
        "sample_id", F.coalesce("genes", zero).alias("genes"), F.coalesce("predictions", zero).alias("predictions"))
    return both.withColumn("conserved", F.col("predictions") == F.col("genes") * n_models)


def require_conserved(kept: DataFrame, shown: int = 5) -> None:
    """Raise when a sample of :func:`row_conservation` is not conserved."""
    bad = kept.where(~F.col("conserved")).orderBy("sample_id").limit(shown).collect()
    if bad:
        raise ValueError("rows are missing: " + "; ".join(
            f"sample {r.sample_id}: {r.genes} genes, {r.predictions} predictions" for r in bad))


def predictions_wide(long: DataFrame, cell_types: Sequence[str] | None = None,
                     suffix: str = MODEL_OUTPUT_SUFFIX) -> DataFrame:
    """Long predictions -> one column per cell type (``{ct}{suffix}``)."""
    values = list(cell_types) if cell_types is not None else list(CELL_TYPES)
    wide = (long.groupBy("sample_id", "gene_name").pivot("cell_type", values)
            .agg(F.max("prediction")))
    return wide.select("sample_id", "gene_name",
                       *[F.col(ct).alias(f"{ct}{suffix}") for ct in values])


def combine_predictions(tables: Sequence[DataFrame], keys: Sequence[str] = ("gene_name",)
                        ) -> DataFrame:
    """Inner-join per-model result tables on the gene key, left-deep.

    Every input is hash-partitioned once on the keys; the chained sort-merge
    joins reuse that partitioning.
    """
    if not tables:
        raise ValueError("no prediction tables")
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, list(keys), "inner")
    return out
