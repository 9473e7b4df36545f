"""Paths of tables that queries write under the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from twasprep.session import ensure_checkpoint_dir


def table_path(spark: SparkSession) -> str:
    """A new path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/twasprep-tables/{uuid.uuid4().hex}"
