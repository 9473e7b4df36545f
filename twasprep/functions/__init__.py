"""Column expressions. All run in the JVM; array lambdas
(``transform``, ``aggregate``, ``zip_with``) are interpreted, the rest is generated code."""

from twasprep.functions.genotype import (  # noqa: F401
    allele_counts_of,
    clean_chromosome,
    dosage_of_gt,
    dosage_of_token,
    folded_maf,
    gt_field_index,
    gt_of_sample_cell,
    natural_chromosome_order,
    reformat_varid,
    render_maf,
    variant_id,
)
from twasprep.functions.vectors import (  # noqa: F401
    array_dot,
    elementwise_mean_of_rows,
    zscore_array,
)
