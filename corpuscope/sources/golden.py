"""Golden question sets: a JSON array of question, expected_ids, type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("question", T.StringType()),
        T.StructField("expected_ids", T.ArrayType(T.StringType())),
        T.StructField("type", T.StringType()),
    ]
)


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """``query_id`` is derived from the question, so it is stable across runs."""
    items = spark.read.option("multiLine", True).schema(SCHEMA).json(path)
    key = F.sha2(F.concat_ws("|", "question", "type", F.array_join("expected_ids", ",")), 256)
    return items.select(key.alias("query_id"), "*")
