"""Work by key with restart: skip what is done, go on past what fails.

The keys without a successful attempt (chromosomes, input files, samples) run as
one job. Where it fails, its keys are dealt by a hash bit to two jobs, and so on,
until a failing job has one key, which becomes a ``failed`` row while all the
others are committed: b bad keys of n cost about b log n more jobs, a run
without bad ones none. Batches are predicates on the keys, never lists, so any
number of keys works; each attempt is appended to a table (stage, key, status,
rows, detail) after its output is committed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twasprep.operators import manifest as MF
from twasprep.plans.tables import table_path

ATTEMPTS = "stage string, key string, status string, rows long, detail string"
#: Hash bits by which keys can be dealt; keys that still share a batch fail together.
BITS = 62

#: ``work(batch)`` commits the output of the batch's rows (those of ``inputs``)
#: and returns ``(key, rows)`` of what it wrote; keys without rows may be absent.
Work = Callable[[DataFrame], DataFrame]


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """The attempts so far (none, where the table does not exist)."""
    from twasprep.plans.workflows import _exists

    if not _exists(spark, path):
        return spark.createDataFrame([], ATTEMPTS)
    return spark.read.schema(ATTEMPTS).parquet(path)


def run_keys(inputs: DataFrame, stage: str, attempts_path: str, work: Work) -> DataFrame:
    """Run ``work`` for every pending key of ``inputs`` (a ``key`` and columns for
    ``work``; several rows may share a key). Returns ``MF.job_summary``.

    An error of ``work`` is the key's, unless Spark itself has stopped."""
    spark = inputs.sparkSession
    todo = MF.pending(inputs, read_attempts(spark, attempts_path), stage)
    # written once: every batch sees the same keys, and none works them out again
    pending = table_path(spark)
    todo.withColumn("_bits", F.shiftrightunsigned(F.xxhash64(F.col("key").cast("string")), 2)) \
        .write.parquet(pending)
    dealt = spark.read.parquet(pending)

    def record(rows: DataFrame) -> None:
        rows.select(F.lit(stage).alias("stage"), F.col("key").cast("string").alias("key"), "status",
                    F.col("rows").cast("long").alias("rows"), F.col("detail").cast("string").alias("detail")
                    ).coalesce(1).write.mode("append").parquet(attempts_path)

    batches = [(0, 0)]
    while batches:
        depth, bits = batches.pop()
        batch = dealt.where(F.col("_bits").bitwiseAND(F.lit(2 ** depth - 1)) == bits).drop("_bits")
        names = batch.select("key").distinct()
        n = names.count()
        if not n:
            continue
        try:
            done = work(batch).select(F.col("key").cast("string").alias("key"), "rows")
            record(names.select(F.col("key").cast("string").alias("key")).join(done, "key", "left").select(
                "key", F.lit(MF.SUCCESS).alias("status"), F.coalesce("rows", F.lit(0)).alias("rows"),
                F.lit(None).alias("detail")))
        except Exception as error:  # noqa: BLE001 - any error of a key is its own
            if spark.sparkContext._jsc.sc().isStopped():
                raise
            if n > 1 and depth < BITS:
                batches += [(depth + 1, bits + 2 ** depth), (depth + 1, bits)]
                continue
            text = str(error).strip().splitlines() or [type(error).__name__]
            record(names.select("key", F.lit("failed").alias("status"), F.lit(0).alias("rows"),
                                F.lit(text[0][:300]).alias("detail")))
    return MF.job_summary(inputs.select("key").distinct(), read_attempts(spark, attempts_path), stage)
