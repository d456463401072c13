"""Context and sources per question from ranked results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.config import EngineConfig
from corpuscope.session import materialize_for_join

# Fixed value: separator between the texts handed on as context.
SEPARATOR = "\n\n"


def assemble(
    results: DataFrame,
    rows: DataFrame,
    config: EngineConfig = EngineConfig(),
    questions: DataFrame | None = None,
) -> DataFrame:
    """``query_id, n_rows, context, sources``: a row for each of ``questions``, with no
    rows, an empty context and no sources where nothing was found.

    ``rows`` has ``row_id, source, page_content``. Texts are joined to the few
    ranked rows only after ranking, so scoring never carries them, and the
    texts are scanned without a shuffle while the results are few. A question
    has at most k rows.
    """
    found = materialize_for_join(results, config.broadcast_rows)
    texts = rows.select("row_id", "source", "page_content").join(found, "row_id")
    ordered = F.sort_array(F.collect_list(F.struct("rank", "page_content")))
    answered = (
        texts.groupBy("query_id")
        .agg(
            F.count("*").alias("n_rows"),
            ordered.alias("ordered"),
            F.array_sort(F.collect_set("source")).alias("sources"),
        )
        .select(
            "query_id",
            "n_rows",
            F.array_join(F.col("ordered.page_content"), SEPARATOR).alias("context"),
            "sources",
        )
    )
    if questions is None:
        return answered
    return questions.select("query_id").join(answered, "query_id", "left").select(
        "query_id",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("context", F.lit("")).alias("context"),
        F.coalesce("sources", F.array().cast("array<string>")).alias("sources"),
    )
