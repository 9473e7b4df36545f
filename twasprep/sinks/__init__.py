"""Writers that render the workflow's text formats (and Parquet stages)."""

from twasprep.sinks.writers import (  # noqa: F401
    export_bundle,
    write_cell_type_matrices,
    write_dosage_matrix,
    write_gene_features,
    write_lines_with_header,
    write_predictdb_expression,
    write_predictions,
    write_region_features,
    write_snp_annotation,
    write_variant_annotation,
)
