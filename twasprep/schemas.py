"""Table schemas and the fixed values the outputs must reproduce."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the upstream workflow's vocabulary and formats).
# ---------------------------------------------------------------------------
# Cell types scored by the expression models, in their documented order.
CELL_TYPES = (
    "pericytes",
    "schwann",
    "lymphocytes",
    "microglia",
    "meninges",
    "astrocytes",
    "ependymal",
    "opc",
    "oligodendrocytes",
    "neurons",
    "endothelial",
)
# Column-name patterns around a cell type name.
MODEL_OUTPUT_SUFFIX = "_mean_expression_predicted_expression"
LEGACY_OUTPUT_SUFFIX = "_mean_expression_mean_expression_predicted_expression"
RENAMED_SUFFIX = "_predicted"
# Genotype text tokens.
MISSING_DOSAGE_TOKEN = "."
UNRESOLVED_RSID = "."
MISSING_MAF_TOKEN = "NA"
CONSTANT_R2 = "1.0"
BUILD_SUFFIX = "_GRCh38"
# Phased genotype strings and their alternate-allele dosage; anything else
# (unphased, multi-allelic codes, haploid, missing) has no dosage.
PHASED_DOSAGE = (("0|0", 0), ("0|1", 1), ("1|0", 1), ("1|1", 2))
# Output key name for the expression export.
EXPORT_KEY = "NAME"
# Marker between the cell type and the rest of a model file name.
MODEL_FILE_MARKER = "_ctPred"
# Numerical constants.
MAF_DIGITS = 5
ZSCORE_EPSILON = 1e-8
FEATURE_WIDTH = 5313
BINS_PER_REGION = 4
LEGACY_CHUNK_ROWS = 5000

# ---------------------------------------------------------------------------
# Canonical schemas
# ---------------------------------------------------------------------------
SNP_ANNOTATION = T.StructType(
    [
        T.StructField("chromosome", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("varID", T.StringType()),
        T.StructField("ref_vcf", T.StringType()),
        T.StructField("alt_vcf", T.StringType()),
        T.StructField("R2", T.DoubleType()),
        T.StructField("MAF", T.DoubleType()),
        T.StructField("rsid", T.StringType()),
        T.StructField("rsid_dbSNP150", T.StringType()),
    ]
)
SNP_ANNOTATION_COLUMNS = tuple(f.name for f in SNP_ANNOTATION.fields)

VARIANT_ANNOTATION = T.StructType(
    [
        T.StructField("varid", T.StringType()),
        T.StructField("chrom", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("ref", T.StringType()),
        T.StructField("alt", T.StringType()),
    ]
)

DBSNP = T.StructType(
    [
        T.StructField("chrom", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("rsid", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("alt", T.StringType()),
        T.StructField("ord", T.LongType()),
    ]
)

REGION_TENSORS = T.StructType(
    [
        T.StructField("sample_id", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("bins", T.ArrayType(T.ArrayType(T.FloatType()))),
    ]
)

REGION_FEATURES = T.StructType(
    [
        T.StructField("sample_id", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("chromo", T.StringType()),
        T.StructField("ord", T.LongType()),
        T.StructField("features", T.ArrayType(T.DoubleType())),
    ]
)

GENE_WINDOWS = T.StructType(
    [
        T.StructField("gene_name", T.StringType()),
        T.StructField("region_names", T.StringType()),
    ]
)

GENE_FEATURES = T.StructType(
    [
        T.StructField("sample_id", T.StringType()),
        T.StructField("gene_name", T.StringType()),
        T.StructField("ord", T.LongType()),
        T.StructField("features", T.ArrayType(T.DoubleType())),
    ]
)

MODEL_WEIGHTS = T.StructType(
    [
        T.StructField("cell_type", T.StringType()),
        T.StructField("layer", T.IntegerType()),
        T.StructField("weights", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("bias", T.ArrayType(T.DoubleType())),
    ]
)

PREDICTIONS_LONG = T.StructType(
    [
        T.StructField("sample_id", T.StringType()),
        T.StructField("gene_name", T.StringType()),
        T.StructField("cell_type", T.StringType()),
        T.StructField("prediction", T.DoubleType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)
