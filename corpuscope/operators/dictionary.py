"""Data dictionaries in JSON: one document per table and per column."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscope.functions.arrays import let
from corpuscope.functions.parsing import OPTION, Parser, option, text_of
from corpuscope.functions.text import given, given_or_null
from corpuscope.model import DOC_ARRAY, doc, no_docs, warning

ENTRY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("description", OPTION),
        T.StructField("column_type", T.StringType()),
        T.StructField("max_length", T.StringType()),
        T.StructField("pii", T.StringType()),
    ]
)
PARSED = T.StructType(
    [
        T.StructField("status", T.StringType()),  # ok | invalid_syntax | unexpected
        T.StructField("error", T.StringType()),
        T.StructField("is_dictionary", T.BooleanType()),
        T.StructField("schema", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("table_description", OPTION),
        T.StructField("primary_key", T.ArrayType(T.StringType())),
        T.StructField("sources", T.ArrayType(T.StringType())),
        T.StructField("columns", T.ArrayType(ENTRY)),
    ]
)


def _result(status: str, error=None, **rest) -> dict:
    return {"status": status, "error": text_of(error), "is_dictionary": False, **rest}


def _entry(name: str, details) -> dict:
    if not isinstance(details, dict):
        return {"name": text_of(name), "error": f"column {text_of(name)!r} is not an object"}
    return {
        "name": text_of(name),
        "description": option(details, "description"),
        "column_type": text_of(details.get("column_type")),
        "max_length": text_of(details.get("max_length")),
        "pii": text_of(details.get("pii_confidentiality_impact_level")),
    }


def _names(value) -> list:
    return [text_of(v) for v in value] if isinstance(value, list) else []


def parse(text: str) -> dict:
    try:
        data = json.loads(text)
    except json.JSONDecodeError as problem:
        return _result("invalid_syntax", problem)
    except Exception as problem:  # numbers beyond the digit limit, deep nesting
        return _result("unexpected", problem)
    if not isinstance(data, dict):
        scalar = not isinstance(data, (list, str))
        if scalar or ("schema" in data and "table" in data):
            return _result("unexpected", "top level is not an object")
        return _result("ok")
    if "schema" not in data or "table" not in data:
        return _result("ok")
    columns = data.get("column_types", {})
    broken = None if isinstance(columns, dict) else "column_types is not an object"
    return {
        "status": "unexpected" if broken else "ok",
        "error": broken,
        "is_dictionary": True,
        "schema": text_of(str(data["schema"])),
        "table": text_of(str(data["table"])),
        "table_description": option(data, "table_description"),
        "primary_key": _names(data.get("table_id")),
        "sources": _names(data.get("source")),
        "columns": [] if broken else [_entry(k, v) for k, v in columns.items()],
    }


PARSER = Parser(parse, PARSED)

# Fixed value: text rendered when a description is missing.
NO_DESCRIPTION = "N/A"


def kept_columns(parsed: Column) -> Column:
    """Columns before the first one that is not an object."""

    def before(columns: Column) -> Column:
        first_bad = F.array_position(F.transform(columns, lambda c: c["error"].isNotNull()), True)
        return F.when(first_bad == 0, columns).otherwise(
            F.slice(columns, F.lit(1), F.greatest(first_bad.cast("int") - 1, F.lit(0)))
        )

    return let(parsed["columns"], before)


def _plain_table(parsed: Column) -> tuple[Column, Column]:
    text = F.concat(
        F.lit("This document describes the table '"),
        parsed["table"],
        F.lit("' in the schema '"),
        parsed["schema"],
        F.lit("'. Description: "),
        given(parsed["table_description"], NO_DESCRIPTION),
    )
    return parsed["table"], text


def _rich_table(parsed: Column) -> tuple[Column, Column]:
    name = F.concat(parsed["schema"], F.lit("."), parsed["table"])

    def listing(lead: str, names: Column) -> Column:
        return F.when(
            F.size(names) > 0, F.concat(F.lit(lead), F.array_join(names, ", "), F.lit("."))
        ).otherwise(F.lit(""))

    text = F.concat(
        F.lit("This document describes the table '"),
        name,
        F.lit("'. Description: "),
        given(parsed["table_description"], NO_DESCRIPTION),
        listing(" The primary key(s) are: ", parsed["primary_key"]),
        listing(" The data is sourced from the following locations: ", parsed["sources"]),
    )
    return name, text


def _plain_column(table: Column, entry: Column) -> Column:
    return F.concat(
        F.lit("In table '"),
        table,
        F.lit("', column '"),
        entry["name"],
        F.lit("' has the description: "),
        given(entry["description"], NO_DESCRIPTION),
    )


def _rich_column(table: Column, entry: Column) -> Column:
    def part(lead: str, value: Column) -> Column:
        return F.concat(F.lit(lead), value, F.lit("'"))

    traits = F.concat_ws(
        ", ",
        part("type '", entry["column_type"]),
        part("a max length of '", entry["max_length"]),
        part("a PII confidentiality impact level of '", entry["pii"]),
    )
    return F.concat(
        F.lit("In table '"),
        table,
        F.lit("', the column '"),
        entry["name"],
        F.lit("'"),
        F.when(traits != "", F.concat(F.lit(" has "), traits)).otherwise(F.lit("")),
        F.lit(". Description: "),
        given(entry["description"], NO_DESCRIPTION),
    )


def derived_documents(parsed: Column, rich: bool = False) -> Column:
    """Table summary, then one document per column in the order of the file.

    ``rich`` adds keys, sources, types and PII levels to the texts.
    """
    table, summary_text = (_rich_table if rich else _plain_table)(parsed)
    column_text = _rich_column if rich else _plain_column
    shared = {
        "schema": parsed["schema"],
        "table": table,
        "table_description": given_or_null(parsed["table_description"], NO_DESCRIPTION),
    }
    summary = doc(kind=F.lit("table"), page_content=summary_text, **shared)
    columns = F.transform(
        kept_columns(parsed),
        lambda c: doc(
            kind=F.lit("column"), page_content=column_text(table, c), column=c["name"], **shared
        ),
    )
    return F.when(parsed["is_dictionary"], F.concat(F.array(summary), columns)).otherwise(
        no_docs()
    ).cast(DOC_ARRAY)


def raw_document(content: Column) -> Column:
    return doc(kind=F.lit("raw"), page_content=content)


def documents(content: Column, parsed: Column, rich: bool = False) -> Column:
    return F.concat(F.array(raw_document(content)), derived_documents(parsed, rich))


def warnings(parsed: Column) -> Column:
    bad = F.get(F.filter(parsed["columns"], lambda c: c["error"].isNotNull()), F.lit(0))
    return (
        F.when(parsed["status"] != "ok", F.array(warning(parsed["status"], parsed["error"])))
        .when(bad["error"].isNotNull(), F.array(warning(F.lit("unexpected"), bad["error"])))
        .otherwise(no_docs())
    )
