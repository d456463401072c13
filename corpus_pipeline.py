"""A training corpus from raw documents: five stages, each a table of its own.

A stage takes (spark, docs, sf_dir) and returns rows; each result is written to the shared
folder and read again as the next stage's docs. All but the last keep the columns of
documents, whatever others there are and however they are named.

Null texts count as empty: toxicity scores them by the bias, exact and near dedup keep one of
them, decontamination keeps it, packing makes it an end token. Repeated rows are judged
alike in toxicity, and exact dedup leaves one of them. Of equal or linked texts the row
with the smallest id stays, null last. Texts are read whole, however long. Empty tables
pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpuscope.llm import decontaminate, exact, packing, simhash, toxicity
from corpuscope.llm.common import stored
from corpuscope.llm.queries import tokenizer


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of a model learnt on this corpus."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, toxicity.fit(docs, labels), toxicity.THRESHOLD)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the one with the smallest id."""
    return exact.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link: three-word shingles, two bits."""
    return simhash.deduplicate(docs, words=3, differing=2)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.reject(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of tokens."""
    return packing.report(docs, tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Scores, fingerprints and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
