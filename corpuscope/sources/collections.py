"""Named collections under one folder: documents, vocabulary, vectors.

Layout: ``{root}/{table}/collection={name}/version={v}/…`` in Parquet. Each indexing
writes a version of its own; the last step adds one small row to ``current``, so readers
see the old collection or the new one, whole, and a failure leaves the old one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscope.operators.coarse import CoarseIndex, open_index
from corpuscope.operators.latent import Latent, load
from corpuscope.operators.postings import open_blocks
from corpuscope.operators.terms import Vocabulary

CURRENT = "current"
CURRENT_SCHEMA = (
    "at long, version string, n_docs long, n_terms long, n_pairs long, parts string"
)


def collection_path(root: str, table: str, collection: str, version: str | None = None) -> str:
    if not re.fullmatch(r"[A-Za-z0-9._-]+", collection):
        raise ValueError(f"not a collection name: {collection!r}")
    path = f"{root.rstrip('/')}/{table}/collection={collection}"
    return path if version is None else f"{path}/version={version}"


def read_part(
    spark: SparkSession,
    root: str,
    table: str,
    collection: str,
    version: str | None = None,
    schema: str | None = None,
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(collection_path(root, table, collection, version))
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(
                f"no collection {collection!r} under {root}; index it first"
            ) from problem
        raise


@dataclass(frozen=True)
class Collection:
    name: str
    documents: DataFrame  # canonical document rows
    warnings: DataFrame  # path, class, message
    vectors: DataFrame  # row_id, metadata, terms, weights, optionally embedding
    vocabulary: Vocabulary
    latent: Latent | None = None  # model of the collection's own dense vectors
    dense: DataFrame | None = None  # row_id, metadata, embedding
    cells: CoarseIndex | None = None  # the same rows by cell
    postings: DataFrame | None = None  # blocks of the term vectors


def open_collection(spark: SparkSession, root: str, collection: str) -> Collection:
    """The stored collection; ``FileNotFoundError`` if it was never indexed."""
    pointers = read_part(spark, root, CURRENT, collection, schema=CURRENT_SCHEMA)
    now = pointers.orderBy(F.desc("at"), "version").first()
    parts = (now.parts or "").split(",")

    def part(table: str) -> DataFrame:
        return read_part(spark, root, table, collection, now.version)

    rows = part("documents").withColumn("collection", F.lit(collection))
    vocabulary = Vocabulary(part("vocabulary"), now.n_docs, now.n_terms, now.n_pairs)
    path = lambda table: collection_path(root, table, collection, now.version)
    vectors = part("vectors").withColumn("collection", F.lit(collection))
    dense = vectors if "embedding" in vectors.columns else None
    cells = blocks = None
    if "latent" in parts:
        dense = part("dense").withColumn("collection", F.lit(collection))
    if "cells" in parts:
        cells = open_index(spark, path("cells"))
    if "postings" in parts:
        blocks = open_blocks(spark, path("postings"), vectors.schema["row_id"].dataType)
    return Collection(
        collection,
        rows.where(F.col("record") == "document").drop("record"),
        warning_rows(rows.where(F.col("record") == "warning")),
        vectors,
        vocabulary,
        load(spark, path("latent")) if "latent" in parts else None,
        dense,
        cells,
        blocks,
    )


def warning_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("source").alias("path"),
        F.col("content_type").alias("class"),
        F.col("page_content").alias("message"),
    )


def latest_warnings(spark: SparkSession, root: str, collection: str) -> DataFrame:
    """Warnings of indexing runs that found no document and so left the collection alone."""
    return warning_rows(read_part(spark, root, "rejected", collection))
