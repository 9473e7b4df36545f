"""Registered queries opN_<name>: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twasprep.llm import (bagminhash, covertree, decontam, merkle, mixing, pii, quality, rtree, secrets,
                          sharding, substrings, toxicity, urls)
from twasprep.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secrets(spark, sf_dir):
    found = secrets.scan_secrets(read_table(spark, sf_dir, "documents"))
    base = F.filter("findings", lambda x: x["layer"] == "")
    count = lambda k: F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(secrets.span_list(base), 256).alias("base_sha256"),
        secrets.span_list(F.col("findings")).alias("spans"), F.col("refused").cast("long").alias("refused"))


def op2_substrings(spark, sf_dir):
    out = substrings.dedup_substrings(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op3_quality(spark, sf_dir):
    out = quality.quality_verdicts(read_table(spark, sf_dir, "documents"),
                                   read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


def op4_pii(spark, sf_dir):
    found = pii.find_personal_data(read_table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in pii.KINDS[:4]],
        F.sha2(secrets.span_list(F.col("spans")), 256).alias("base_sha256"),
        secrets.span_list(pii.all_spans(F.col("spans"), F.col("terms"))).alias("spans"))


def op5_mixing(spark, sf_dir):
    return mixing.poisson_mix(read_table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark, sf_dir):
    return bagminhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    out = toxicity.score_documents(read_table(spark, sf_dir, "documents"),
                                   read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op8_sharding(spark, sf_dir):
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def op9_urls(spark, sf_dir):
    return urls.filter_urls(read_table(spark, sf_dir, "pages"))


def op10_decontamination(spark, sf_dir):
    return decontam.leaks(read_table(spark, sf_dir, "documents"),
                          read_table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark, sf_dir):
    return rtree.hard_negatives(read_table(spark, sf_dir, "embeddings"))


def op12_manifest(spark, sf_dir):
    return merkle.manifest(read_table(spark, sf_dir, "documents"))


def op13_top_k(spark, sf_dir):
    return covertree.top_k(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_secrets, op2_substrings, op3_quality, op4_pii, op5_mixing, op6_near_duplicates,
    op7_toxicity, op8_sharding, op9_urls, op10_decontamination, op11_hard_negatives,
    op12_manifest, op13_top_k)}
