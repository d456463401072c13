"""Processors that are Python table functions: one call per file, any number of documents.

A processor is a class as for ``pyspark.sql.functions.udtf`` with ``analyze(path, content)``, which
names the document fields it yields, and ``eval(path, content)``. It is called laterally for
each file of its extension. What it yields becomes document rows in its order; if it fails on a
file, the rows so far stay and a warning row says why, as for the built-in processors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeResult

from corpuscope.model import DOC_FIELDS, DOC_STRUCT, WARNING_KIND, with_row_id

_ROW = T.StructType([T.StructField("ordinal", T.IntegerType()), *DOC_STRUCT.fields])


@dataclass
class _Fields(AnalyzeResult):
    """The row schema, and which of its fields the processor yields, in order."""

    names: tuple = ()


def guarded(handler: type) -> type:
    """A table function with all document fields, around one with some of them."""

    class Guarded:
        def __init__(self, analyzed=None):
            self.names = analyzed.names if analyzed is not None else ()

        @staticmethod
        def analyze(path, content):
            names = tuple(handler.analyze(path, content).schema.fieldNames())
            unknown = sorted(set(names) - set(DOC_FIELDS))
            if unknown:
                raise ValueError(f"no document fields: {unknown}")
            return _Fields(_ROW, names=names)

        def eval(self, path, content):
            place = [self.names.index(f) if f in self.names else -1 for f in DOC_FIELDS]
            ordinal = 0
            try:
                for row in handler().eval(path, content):
                    texts = [None if k < 0 or row[k] is None else str(row[k]) for k in place]
                    yield (ordinal, *texts)
                    ordinal += 1
            except Exception as problem:
                said = {"kind": WARNING_KIND, "content_type": "unexpected", "page_content": str(problem)}
                yield (ordinal, *(said.get(f) for f in DOC_FIELDS))

    return Guarded


def table_documents(files: DataFrame, handler: type) -> DataFrame:
    """Document and warning rows of ``path, content, status, error``."""
    function = F.udtf(guarded(handler))
    good = files.where(F.col("status") == "ok").select("path", "content")
    rows = good.lateralJoin(function(F.col("path").outer(), F.col("content").outer()))
    said = {
        "ordinal": F.lit(0),
        "kind": F.lit(WARNING_KIND),
        "content_type": F.col("status"),
        "page_content": F.col("error"),
    }
    bad = files.where(F.col("status") != "ok").select(
        F.col("path").alias("source"),
        *(said.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in _ROW.fields),
    )
    named = rows.select(F.col("path").alias("source"), *_ROW.fieldNames())
    return with_row_id(named.unionByName(bad))
