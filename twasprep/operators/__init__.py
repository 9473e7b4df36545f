"""Table operators (DataFrame in, DataFrame out).

* ``genotype``   - dosages (array and long layouts), matrices, allele counts,
                   MAF, SNP annotation, variant-id rewrite, chromosome order
* ``rsid``       - dbSNP identifier resolution, statistics, naming report
* ``features``   - bin means, gene-window means, chunked legacy mode
* ``predict``    - keep-first, per-sample z-scores, scorers, predictions
* ``expression`` - renaming, wide/long reshaping, cell-type matrices,
                   Ensembl mapping, unmapped-gene report
* ``validate``   - matrix shape and content checks
* ``manifest``   - pending work and job summaries
* ``common``     - skew-safe keep-first / last-wins / top-n, size-checked
                   broadcast, helpers
"""
