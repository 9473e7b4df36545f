"""Training-data operators (secrets, dedup, quality, PII, mixing, toxicity,
sharding, URL filters, decontamination) and their registered queries.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
