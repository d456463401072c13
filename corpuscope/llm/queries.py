"""Registered queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscope.llm import (
    chatformat,
    collocations,
    decontaminate,
    exact,
    packing,
    repair,
    secrets,
    sentences,
    sharding,
    simhash,
    substrings,
    toxicity,
    warc,
)


def tokenizer() -> str:
    """Path of the tokenizer file, which is the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def op1_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(_documents(spark, sf_dir))


def op2_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(_documents(spark, sf_dir), tokenizer())


def op3_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(_documents(spark, sf_dir))


def op4_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(_documents(spark, sf_dir))


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.report(_documents(spark, sf_dir), benchmark)


def op6_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.report(_documents(spark, sf_dir))


def op7_archived_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.report(_documents(spark, sf_dir), labels)


def op9_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(_documents(spark, sf_dir))


def op10_repeated_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.report(_documents(spark, sf_dir))


def op11_chat_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"),
    )
    rows = _conversations(spark, sf_dir).select("conv_id", "turn", "role", "text")
    return chatformat.report(rows.unionByName(more))


def op12_repaired_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(_conversations(spark, sf_dir))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.report(_documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # which imports this module

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_repeated_bytes,
        op2_packed_sequences,
        op3_simhash_components,
        op4_byte_shards,
        op5_benchmark_leaks,
        op6_exact_groups,
        op7_archived_pages,
        op8_toxicity_scores,
        op9_secret_spans,
        op10_repeated_sentences,
        op11_chat_texts,
        op12_repaired_turns,
        op13_phrases,
        pipeline,
    )
}

ORACLES = {
    "op6_exact_groups": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
            doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op10_repeated_sentences": sentences.SQL,
    "op11_chat_texts": chatformat.SQL,
    "op12_repaired_turns": repair.SQL,
    "op13_phrases": collocations.SQL,
}
