"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet below ``spark.checkpoint.dir`` and rereads them, so
a lost executor costs a stage's tasks and never the stages before it.

Edge cases: rows with a null or short text fail the quality rules; null ids,
languages and sources are values of their own; equal rows are one document to the
near-dedup and draw alike in the mixing; of tied representatives the least id
stays; texts of any length pass whole; columns of any other name pass through
every stage but the last unchanged; empty tables give no rows, an empty benchmark
or label table leaves the documents alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from twasprep.llm import bagminhash, decontam, mixing, quality, sharding
from twasprep.llm.common import materialise, read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a risk-controlled cutoff go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return bagminhash.keep_one_per_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within the edit budget go."""
    return decontam.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson counts towards the target weights, shuffled."""
    return mixing.poisson_copies(docs)


def make_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return sharding.shard(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", make_shards),
]

#: The near-duplicate stage (verified hash signatures and components) and the
#: banded alignments have no SQL form; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the rows of the last stage."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
