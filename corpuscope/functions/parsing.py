"""Run small per-file Python parsers as one Arrow stage."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# ``present`` tells a missing key from an explicit null.
OPTION = T.StructType(
    [T.StructField("present", T.BooleanType()), T.StructField("value", T.StringType())]
)


@dataclass(frozen=True)
class Parser:
    """``parse`` turns the text of one file into a value of ``schema``."""

    parse: Callable[[str], Any]
    schema: T.DataType


def text_of(value: Any) -> str | None:
    """String form of a scalar; characters Arrow cannot carry are replaced."""
    if value is None:
        return None
    text = value if isinstance(value, str) else str(value)
    if text.isascii():
        return text
    return text.encode("utf-8", "replace").decode("utf-8")


def option(mapping: Mapping, key: str) -> dict:
    if key not in mapping:
        return {"present": False, "value": None}
    return {"present": True, "value": text_of(mapping[key])}


def with_parsed(
    files: DataFrame, parsers: Mapping[str, Parser], keep: tuple[str, ...] | None = None
) -> DataFrame:
    """Add a struct column ``parsed`` with one field per key of ``parsers``.

    ``files`` has ``path, ext, content``; only the field whose key equals the
    row's ``ext`` is filled. One pass over the files, whatever their kind. Of the other
    columns those in ``keep`` come back, all by default.
    """
    keys = list(parsers)
    names = [f"p{i}" for i in range(len(keys))]
    types = [to_arrow_type(parsers[k].schema) for k in keys]
    functions = [parsers[k].parse for k in keys]
    struct = T.StructType([T.StructField(n, parsers[k].schema) for n, k in zip(names, keys)])
    kept = list(files.columns if keep is None else keep)
    schema = T.StructType([files.schema[n] for n in kept] + [T.StructField("parsed", struct)])

    def run(batches):
        for batch in batches:
            exts = batch.column("ext").to_pylist()
            texts = batch.column("content")
            columns = []
            for key, function, arrow_type in zip(keys, functions, types):
                values = [
                    function(texts[i].as_py()) if e == key and texts[i].is_valid else None
                    for i, e in enumerate(exts)
                ]
                columns.append(pa.array(values, type=arrow_type))
            parsed = pa.StructArray.from_arrays(columns, names=names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept] + [parsed], names=kept + ["parsed"]
            )

    return files.mapInArrow(run, schema)
