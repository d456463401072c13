"""Shared scratch space: where lineage may be cut and tables staged."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="corpuscope-"))
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut lineage with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_for_join(df: DataFrame, most_rows: int) -> DataFrame:
    """Compute a side that is expected to be small, and look at its size.

    Up to ``most_rows`` rows it is broadcast, so the other side of a join stays
    where it is; above that the planner decides as for any table.
    """
    stored = materialize(df)
    return F.broadcast(stored) if stored.count() <= most_rows else stored


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
