"""Registered queries that put the text sinks under the gate: each writes its
output to files, reads the bytes back and reports their digest per partition."""

from __future__ import annotations

from pyspark.sql import functions as F

from twasprep.operators import expression as X
from twasprep.operators import features as FT
from twasprep.operators import predict as P
from twasprep.operators import rsid as R
from twasprep.plans import driver_views as V
from twasprep.plans.tables import table_path
from twasprep.sinks import writers as W
from twasprep.sinks.ledger import changed_files, file_ledger, text_digest

#: Vector elements in the CSV sinks (the tables' embeddings are longer), in small
#: whole numbers, and digits of their means: the sinks' text is compared, and the
#: two engines print long fractions differently.
WIDTH, DIGITS = 3, 4


def _short(df):
    return df.withColumn("features", F.transform(F.slice("features", 1, WIDTH),
                                                   lambda x: F.round(x * 8) + F.lit(0.0)))


def _checked(spark, path, partition=None, header=True):
    """The digest of what was written, once the ledger agrees with the files."""
    ledger = file_ledger(spark, path, header)
    bad = changed_files(ledger, file_ledger(spark, path, header)).isEmpty()
    return text_digest(spark, path, partition, header).withColumn("unchanged", F.lit(bad))


def q_sink_variant_annotation(spark, sf_dir):
    path = table_path(spark)
    W.write_variant_annotation(V.variant_annotation_rows(spark, sf_dir), path)
    return _checked(spark, path, header=False)


def q_sink_snp_rsids(spark, sf_dir):
    path = table_path(spark)
    resolved = R.resolve_rsids(V.snp_annotation_rows(spark, sf_dir), V.dbsnp_rows(spark, sf_dir))
    W.write_snp_annotation(resolved, path, missing_maf="", partition_by="chromosome")
    return _checked(spark, path, "chromosome_part")


def q_sink_region_features(spark, sf_dir):
    path = table_path(spark)
    W.write_region_features(_short(V.region_features(spark, sf_dir)), path, fmt="csv", width=WIDTH)
    return _checked(spark, path, "sample_id")


def q_sink_gene_features(spark, sf_dir):
    path = table_path(spark)
    means = FT.gene_region_means(V.gene_windows(spark, sf_dir), _short(V.region_features(spark, sf_dir)))
    means = means.withColumn("features", F.transform("features", lambda x: F.round(x, DIGITS) + F.lit(0.0)))
    W.write_gene_features(means, path, fmt="csv", width=WIDTH)
    return _checked(spark, path, "sample_id")


def q_sink_predictions(spark, sf_dir):
    path = table_path(spark)
    long = P.predict_expression(_short(V.gene_features(spark, sf_dir)), P.RuleLinearScorer(["neurons", "opc"]))
    wide = P.predictions_wide(long.withColumn("prediction", F.round("prediction", DIGITS) + F.lit(0.0)),
                              ["neurons", "opc"])
    W.write_predictions(wide, path)
    return _checked(spark, path, "sample_id")


def q_sink_predictdb(spark, sf_dir):
    path = table_path(spark)
    e = X.to_predictdb_expression(V.expression_matrix(spark, sf_dir), V.gene_annotation_rows(spark, sf_dir))
    W.write_predictdb_expression(e, path)
    return _checked(spark, path)


QUERIES = {
    "sink_variant_annotation": q_sink_variant_annotation,
    "sink_snp_rsids": q_sink_snp_rsids,
    "sink_region_features": q_sink_region_features,
    "sink_gene_features": q_sink_gene_features,
    "sink_predictions": q_sink_predictions,
    "sink_predictdb": q_sink_predictdb,
}
