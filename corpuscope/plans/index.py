"""Indexing job: documents are written first, everything else reads them back.

Each step ends in a table on shared storage, so a lost executor costs tasks of
one step and never a second parse of the repository.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpuscope.config import EngineConfig
from corpuscope.model import DOCUMENT_SCHEMA, WARNING_KIND
from corpuscope.operators import coarse, latent, postings, terms
from corpuscope.plans.ingest import ingest, ingest_repository, with_extension
from corpuscope.session import materialize, materialize_for_join
from corpuscope.sources.collections import (
    CURRENT,
    CURRENT_SCHEMA,
    Collection,
    collection_path,
    open_collection,
    read_part,
)
from corpuscope.sources.repo_files import read_repository

# A function that adds an ``embedding array<float>`` column from ``page_content``.
Vectoriser = Callable[[DataFrame], DataFrame]

METADATA = [f for f in DOCUMENT_SCHEMA.fieldNames() if f != "page_content"]


@dataclass(frozen=True)
class Extras:
    """What a collection has besides term vectors: dense vectors, from a ``vectoriser`` or its
    own of ``dense`` columns, a coarse index over them (``cells``), and postings in the
    order of their impact (``blocks``)."""

    vectoriser: Vectoriser | None = None
    dense: int | None = None
    cells: coarse.Cells | None = None
    blocks: postings.Shape | None = None


class _Version:
    """Tables of one version of a collection while it is written."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.root, self.name = spark, root, name
        self.version = uuid.uuid4().hex

    def path(self, table: str) -> str:
        return collection_path(self.root, table, self.name, self.version)

    def write(self, df: DataFrame, table: str, *partitions: str) -> DataFrame:
        df.write.partitionBy(*partitions).parquet(self.path(table))
        # An empty table leaves no file to read a schema from.
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def documents(self, rows: DataFrame) -> tuple[DataFrame, int]:
        """Stores documents and warnings; they are counted by the write itself."""
        record = F.when(F.col("kind") == WARNING_KIND, "warning").otherwise("document")
        seen = Observation()
        marked = rows.withColumn("record", record)
        stored = self.write(
            marked.observe(seen, F.count_if(F.col("record") == "document").alias("n_docs")),
            "documents", "record",
        )
        return stored, int(seen.get["n_docs"] or 0)

    def reject(self, stored: DataFrame) -> None:
        path = collection_path(self.root, "rejected", self.name)
        stored.drop("record").write.mode("append").parquet(path)

    def finish(
        self,
        counted: DataFrame,
        frequencies: DataFrame,
        n_docs: int,
        config: EngineConfig,
        extras: Extras,
        parts: tuple[str, ...] = (),
    ) -> None:
        """Vocabulary, vectors and what else is wanted; then the pointer."""
        vocabulary = terms.vocabulary_of(self.write(frequencies, "vocabulary"), n_docs)
        kept = tuple(c for c in counted.columns if c not in ("row_id", "counts"))
        vectors = self.write(terms.weighted(counted, vocabulary, config, kept), "vectors")
        dense, parts = vectors, list(parts)
        if extras.dense is not None and extras.vectoriser is None:
            model = latent.fit(vectors, vocabulary, extras.dense)
            latent.store(self.spark, model, self.path("latent"))
            embedded = latent.embed(vectors, model).withColumn(
                "embedding", F.col("embedding").cast("array<float>")
            )
            dense = self.write(embedded.drop("terms", "weights"), "dense")
            parts.append("latent")
        if extras.cells is not None and "embedding" in dense.columns:
            coarse.store(dense.drop("terms", "weights"), self.path("cells"), extras.cells)
            parts.append("cells")
        if extras.blocks is not None:
            own = vectors.select("row_id", "terms", "weights")
            postings.store(own, self.path("postings"), extras.blocks)
            parts.append("postings")
        size = (vocabulary.n_docs, vocabulary.n_terms, vocabulary.n_pairs)
        now = (time.time_ns(), self.version, *size, ",".join(parts))
        pointer = self.spark.createDataFrame([now], CURRENT_SCHEMA).coalesce(1)
        pointer.write.mode("append").parquet(collection_path(self.root, CURRENT, self.name))


def _counted(documents: DataFrame, extras: Extras) -> DataFrame:
    kept = [f for f in METADATA if f != "row_id"]
    if extras.vectoriser is not None:
        documents = extras.vectoriser(documents)
        kept.append("embedding")
    return terms.term_counts(documents, keep=tuple(kept))


def write_collection(
    rows: DataFrame,
    root: str,
    config: EngineConfig = EngineConfig(),
    vectoriser: Vectoriser | None = None,
    **options,
) -> bool:
    """Store ingested rows as ``config.collection``; False if there are no documents.

    Documents and warnings come from the same pass over the files. The new version is
    used once all of it is written. Without documents the collection stays as it is, and
    the warnings are kept beside it (``latest_warnings``). ``options`` are those of
    ``Extras``.
    """
    extras = Extras(vectoriser, **options)
    version = _Version(rows.sparkSession, root, config.collection)
    stored, n_docs = version.documents(rows)
    if not n_docs:
        version.reject(stored)
        return False
    documents = stored.where(F.col("record") == "document")
    counted = version.write(_counted(documents, extras), "counts")
    version.finish(counted, terms.frequencies_of(counted), n_docs, config, extras)
    return True


def update_collection(
    files: DataFrame,
    root: str,
    config: EngineConfig = EngineConfig(),
    processors=None,
    vectoriser: Vectoriser | None = None,
    **options,
) -> bool:
    """Bring a collection to the state of ``files`` (path, content and, if known, status and
    error); False if that leaves no documents.

    A manifest has the digest of each file. Only files that are new or differ are parsed; rows
    of files that differ or are gone are left out, all others are carried over with their
    term counts, and document frequencies change by signed differences. What results is what
    a full indexing of ``files`` gives. Without an earlier update everything is new.
    """
    spark, extras = files.sparkSession, Extras(vectoriser, **options)
    version = _Version(spark, root, config.collection)
    files = with_extension(files, config.extensions)
    told = F.concat_ws("|", "status", F.coalesce("error", F.lit("")), F.coalesce("content", F.lit("")))
    manifest = version.write(files.select("path", F.sha2(told, 256).alias("digest")), "manifest")
    before = _tables_with_manifest(spark, root, config.collection)
    changed, old_rows, old_counts = manifest, None, None
    if before is not None:
        # Both lists are counted before they are broadcast.
        changed = manifest.join(before["manifest"], ["path", "digest"], "left_anti")
        gone = before["manifest"].join(manifest, ["path", "digest"], "left_anti")
        gone = materialize_for_join(gone.select(F.col("path").alias("source")), config.broadcast_rows)
        old_rows = before["documents"].drop("record").join(gone, "source", "left_anti")
        old_counts = before["counts"].join(gone, "source", "left_anti")
        lost = before["counts"].join(gone, "source", "left_semi")
    changed = materialize_for_join(changed.select("path"), config.broadcast_rows)
    rows = ingest(files.join(changed, "path", "left_semi"), config, processors)
    if old_rows is not None:
        rows = old_rows.select(rows.columns).unionByName(rows)
    stored, n_docs = version.documents(rows)
    if not n_docs:
        version.reject(stored)
        return False
    documents = stored.where(F.col("record") == "document")
    if old_rows is None:
        counted = version.write(_counted(documents, extras), "counts")
        frequencies = terms.frequencies_of(counted)
    else:
        fresh = documents.join(changed.withColumnRenamed("path", "source"), "source", "left_semi")
        added = materialize(_counted(fresh, extras))
        counted = version.write(old_counts.select(added.columns).unionByName(added), "counts")
        frequencies = terms.changed_frequencies(
            before["vocabulary"], terms.frequencies_of(added), terms.frequencies_of(lost)
        )
    version.finish(counted, frequencies, n_docs, config, extras, ("manifest",))
    return True


def _tables_with_manifest(spark: SparkSession, root: str, name: str) -> dict | None:
    try:
        pointers = read_part(spark, root, CURRENT, name, schema=CURRENT_SCHEMA)
    except FileNotFoundError:
        return None
    now = pointers.orderBy(F.desc("at"), "version").first()
    if "manifest" not in (now.parts or "").split(","):
        return None
    return {
        t: read_part(spark, root, t, name, now.version)
        for t in ("manifest", "documents", "counts", "vocabulary")
    }


def update_repository(
    spark: SparkSession,
    repository: str,
    root: str,
    config: EngineConfig = EngineConfig(),
    processors=None,
    **options,
) -> Collection | None:
    """Index a repository, or what changed in it since; None if nothing is left."""
    files = read_repository(spark, repository, config.extensions, config.read_partitions)
    if not update_collection(materialize(files), root, config, processors, **options):
        return None
    return open_collection(spark, root, config.collection)


def index_repository(
    spark: SparkSession,
    repository: str,
    root: str,
    config: EngineConfig = EngineConfig(),
    vectoriser: Vectoriser | None = None,
    processors=None,
    **options,
) -> Collection | None:
    """Read, ingest and store a repository; None if nothing was found. ``options`` are those of
    ``write_collection``."""
    rows = ingest_repository(spark, repository, config, processors)
    if not write_collection(rows, root, config, vectoriser, **options):
        return None
    return open_collection(spark, root, config.collection)
