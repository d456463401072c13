"""Canonical document schema and helpers to build document structs."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Attributes of one derived document, in canonical order. All are nullable
# strings so that they prune and push down as ordinary Parquet columns.
DOC_FIELDS = (
    "kind",
    "doc_id",
    "page_content",
    "content_type",
    "dag_id",
    "owner",
    "task_name",
    "operator",
    "schedule",
    "dag_description",
    "script_file",
    "schema",
    "table",
    "column",
    "table_description",
    "function_name",
)

# Attributes a question may filter on.
FILTERABLE = ("source", "row_id", "collection", "ordinal") + tuple(
    f for f in DOC_FIELDS if f != "page_content"
)

DOC_STRUCT = T.StructType([T.StructField(f, T.StringType()) for f in DOC_FIELDS])
DOC_ARRAY = T.ArrayType(DOC_STRUCT)

WARNING_KIND = "warning"


@dataclass(frozen=True)
class Wanted:
    """Kinds and fields of documents that are asked for (None: all); others need not be built."""

    kinds: Collection[str] | None = None
    fields: Collection[str] | None = None

    def kind(self, name: str) -> bool:
        return self.kinds is None or name in self.kinds

    def field(self, name: str) -> bool:
        return self.fields is None or name in self.fields


def doc(wanted: Wanted = Wanted(), **fields: Column) -> Column:
    """Struct of one document; fields that are not given, or not wanted, are null."""
    unknown = set(fields) - set(DOC_FIELDS)
    if unknown:
        raise ValueError(f"unknown document fields: {sorted(unknown)}")
    null = F.lit(None).cast("string")
    return F.struct(
        *[(fields.get(f, null) if wanted.field(f) else null).alias(f) for f in DOC_FIELDS]
    )


def no_doc() -> Column:
    """The place of a document that is not wanted."""
    return F.lit(None).cast(DOC_STRUCT)


def no_docs() -> Column:
    return F.array().cast(DOC_ARRAY)


def warning(klass: Column, message: Column) -> Column:
    """A problem found in a file, carried in the same row shape as documents."""
    return doc(kind=F.lit(WARNING_KIND), content_type=klass, page_content=message)


def explode_documents(df: DataFrame, docs: Column) -> DataFrame:
    """One row per element of ``docs``; position in the file becomes ``ordinal``.

    ``df`` must have a ``path`` column. Nothing is shuffled.
    """
    rows = df.select(F.col("path").alias("source"), F.posexplode(docs).alias("ordinal", "d"))
    return with_row_id(rows.select("source", "ordinal", "d.*"))


def with_row_id(rows: DataFrame) -> DataFrame:
    """The canonical columns of rows with ``source, ordinal`` and the document fields."""
    key = F.concat_ws("|", "source", "kind", F.col("ordinal").cast("string"))
    return rows.select(F.sha2(key, 256).alias("row_id"), "source", "ordinal", *DOC_FIELDS)


DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
    ]
    + list(DOC_STRUCT.fields)
)
