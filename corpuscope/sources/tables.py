"""Parquet tables as input of per-row work that is costly for its bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_spread(spark: SparkSession, path: str) -> DataFrame:
    """The table in at least as many partitions as there are cores.

    A table of fewer splits than cores is small, so it is dealt out again; a
    larger one already has enough splits and is not shuffled.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if splits >= cores else df.repartition(cores)


def partitions_for(*tables: DataFrame, bytes_per_partition: int = 32 << 20) -> int:
    """Partitions of a shuffle whose output is parsed in Python.

    Such a shuffle needs a number of its own: adaptive coalescing looks at bytes
    and would leave too few tasks for the work. At least one per core, more as
    the stored size of the inputs grows.
    """
    size = sum(int(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) for t in tables)
    cores = tables[0].sparkSession.sparkContext.defaultParallelism
    return max(cores, -(-size // bytes_per_partition))
