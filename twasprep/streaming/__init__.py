"""Incremental variants of the batch jobs (Structured Streaming, availableNow)."""

from twasprep.streaming.landing import (  # noqa: F401
    run_file_batches,
    stream_bin_means,
    stream_row_local,
    stream_scores,
    stream_vcf_landing,
)
