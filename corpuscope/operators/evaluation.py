"""Retrieval quality: containment, hit rate and mean reciprocal rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.config import MIN_HIT_RATE, MIN_MRR


def mark_expected(results: DataFrame, golden: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every golden question with its ranked rows and whether each is expected.

    ``golden``: ``query_id, expected_ids``; ``results``: ``query_id, rank`` and
    ``key``. Questions without results keep one row with a null rank.
    """
    expected = golden.select("query_id", F.explode("expected_ids").alias(key)).distinct()
    ranked = results.select("query_id", "rank", F.col(key)).join(
        expected.withColumn("hit", F.lit(True)), ["query_id", key], "left"
    )
    return golden.select("query_id").join(ranked, "query_id", "left").select(
        "query_id", "rank", F.coalesce("hit", F.lit(False)).alias("hit")
    )


def per_question(marked: DataFrame) -> DataFrame:
    """``query_id, hit, reciprocal_rank`` (0 if nothing expected was found)."""
    first = F.min(F.when(F.col("hit"), F.col("rank")))
    return marked.groupBy("query_id").agg(
        F.coalesce(F.bool_or("hit"), F.lit(False)).alias("hit"),
        F.coalesce(F.lit(1.0) / first, F.lit(0.0)).alias("reciprocal_rank"),
    )


def summary(
    questions: DataFrame, min_hit_rate: float = MIN_HIT_RATE, min_mrr: float = MIN_MRR
) -> DataFrame:
    """One row: number of questions, hit rate, MRR and whether both bars hold."""
    rates = questions.agg(
        F.count("*").alias("n_questions"),
        F.round(F.avg(F.col("hit").cast("double")), 6).alias("hit_rate"),
        F.round(F.avg("reciprocal_rank"), 6).alias("mrr"),
    )
    return rates.select(
        "*",
        (F.col("hit_rate") >= min_hit_rate).alias("hit_rate_ok"),
        (F.col("mrr") >= min_mrr).alias("mrr_ok"),
    )


def containment(results: DataFrame, golden: DataFrame, key: str = "doc_id") -> DataFrame:
    """``query_id, n_missing, found_all``: is every expected row retrieved?"""
    retrieved = results.groupBy("query_id").agg(F.collect_set(key).alias("retrieved"))
    missing = F.size(
        F.array_except("expected_ids", F.coalesce("retrieved", F.array().cast(
            retrieved.schema["retrieved"].dataType)))
    )
    return golden.join(retrieved, "query_id", "left").select(
        "query_id", missing.alias("n_missing"), (missing == 0).alias("found_all")
    )
