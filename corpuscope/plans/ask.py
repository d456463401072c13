"""Answer a batch of questions from a collection."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.config import EngineConfig
from corpuscope.functions.text import strip
from corpuscope.model import FILTERABLE
from corpuscope.operators import answers, latent, terms
from corpuscope.operators.coarse import nearest_stored
from corpuscope.operators.filters import to_column
from corpuscope.operators.nearest import nearest, nearest_diverse, question_warnings
from corpuscope.operators.postings import nearest_posted
from corpuscope.plans.index import Vectoriser
from corpuscope.sources.collections import Collection


def question_vectors(
    questions: DataFrame,
    vocabulary: terms.Vocabulary,
    config: EngineConfig = EngineConfig(),
) -> DataFrame:
    """Term vectors of ``query_id, question``; other columns are kept."""
    kept = tuple(c for c in questions.columns if c not in ("query_id", "row_id"))
    asked = questions.withColumn("row_id", F.col("query_id"))
    vectors = terms.vectors(asked, vocabulary, "question", config, kept)
    return vectors.withColumnRenamed("row_id", "query_id")


def retrieve(
    collection: Collection,
    questions: DataFrame,
    k: int | None = None,
    where: dict | None = None,
    diverse: bool = False,
    vectoriser: Vectoriser | None = None,
    config: EngineConfig = EngineConfig(),
    dense: bool = False,
    probes: int | None = None,
) -> DataFrame:
    """``query_id, rank, row_id, score`` for ``query_id, question[, filter, limit]``.

    ``where`` holds for all questions and reaches the scan; a ``filter`` column
    holds per question. With a ``vectoriser`` dense embeddings are compared, with ``dense``
    those of the collection's own model. ``probes`` cells of a stored coarse index are read
    instead of all rows. Terms are looked up in stored postings if there are any and no
    metadata is asked for.
    """
    k = k or config.top_k
    asked = questions.where(F.length(strip(F.col("question"))) > 0)
    if dense:
        if collection.latent is None:
            raise ValueError(f"collection {collection.name!r} has no dense vectors of its own")
        vectoriser = latent.vectoriser(collection.vocabulary, collection.latent)
    rows = collection.vectors if vectoriser is None else collection.dense
    if probes is not None and vectoriser is not None and collection.cells and not diverse:
        asked = vectoriser(asked.withColumn("page_content", F.col("question")))
        index = collection.cells
        if where is not None:
            index = replace(index, rows=index.rows.where(to_column(where, FILTERABLE)))
        return nearest_stored(index, asked, k, "cosine", probes, config)
    plain = where is None and not diverse and "filter" not in questions.columns
    if plain and vectoriser is None and collection.postings is not None:
        asked = question_vectors(asked, collection.vocabulary, config)
        return nearest_posted(collection.postings, asked, k)
    if where is not None:
        rows = rows.where(to_column(where, FILTERABLE))
    if vectoriser is None:
        kind, asked = "terms", question_vectors(asked, collection.vocabulary, config)
    else:
        kind = "cosine"
        asked = vectoriser(asked.withColumn("page_content", F.col("question")))
    if diverse:
        return nearest_diverse(
            asked, rows, k, kind, config.fetch_k, config.mmr_lambda, config
        )
    return nearest(asked, rows, k, kind, config)


def ask(collection: Collection, questions: DataFrame, **options) -> DataFrame:
    """``query_id, n_rows, context, sources`` of each question that is not blank.

    Why a question got no rows because of its filter, ``question_warnings`` tells.
    """
    asked = questions.where(F.length(strip(F.col("question"))) > 0)
    found = retrieve(collection, questions, **options)
    return answers.assemble(found, collection.documents, questions=asked)


def warnings(collection: Collection, questions: DataFrame) -> DataFrame:
    """``query_id, class, message`` of questions whose filter cannot be used."""
    return question_warnings(questions, collection.vectors)
