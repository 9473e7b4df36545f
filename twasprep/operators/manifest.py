"""Idempotent batch bookkeeping: which inputs still need work.

A manifest table ``(stage, key, status, rows)`` records every attempt;
pending work is an anti-join of the input keys against successful entries,
so failed outputs are retried and finished ones skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUCCESS = "success"


def pending(inputs: DataFrame, manifest: DataFrame, stage: str, key: str = "key") -> DataFrame:
    """Input keys of ``stage`` without a successful manifest entry."""
    done = (manifest.where((F.col("stage") == stage) & (F.col("status") == SUCCESS))
            .select(F.col("key").alias("_done")))
    return inputs.join(done, inputs[key] == done["_done"], "left_anti")


def job_summary(inputs: DataFrame, manifest: DataFrame, stage: str, key: str = "key"
                ) -> DataFrame:
    """Per status (success / failed / pending): number of inputs and rows.

    An input is ``success`` when any attempt succeeded, ``failed`` when it
    was attempted without success, else ``pending``.
    """
    per_key = (manifest.where(F.col("stage") == stage).groupBy("key").agg(
        F.max(F.col("status") == SUCCESS).alias("_ok"),
        F.sum(F.when(F.col("status") == SUCCESS, F.col("rows"))).alias("_rows")))
    j = inputs.select(F.col(key).alias("key")).join(per_key, "key", "left")
    status = (F.when(F.col("_ok"), F.lit("success"))
              .when(F.col("_ok").isNotNull(), F.lit("failed"))
              .otherwise(F.lit("pending")))
    return j.groupBy(status.alias("status")).agg(
        F.count(F.lit(1)).alias("inputs"),
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("rows"))
