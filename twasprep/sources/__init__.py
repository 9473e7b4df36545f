"""Readers for the workflow's landing formats. All return DataFrames."""

from twasprep.sources.text import (  # noqa: F401
    discover_chromosomes,
    file_stem,
    list_files,
    read_lines,
    read_sample_list,
)
from twasprep.sources.vcf import VcfTable, parse_vcf, read_vcf  # noqa: F401
from twasprep.sources.tables import (  # noqa: F401
    parse_dosage_matrix,
    parse_variant_annotation,
    read_cell_type_matrix,
    read_dbsnp_vcf,
    read_dosage_matrix,
    read_feature_csv,
    read_gene_annotation,
    read_gene_windows,
    read_predictions_csv,
    read_snp_annotation,
    read_variant_annotation,
)
