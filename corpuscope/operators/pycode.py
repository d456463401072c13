"""Python sources: imported libraries and function inventory."""

from __future__ import annotations

import ast
import warnings as _warnings

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscope.functions.parsing import Parser, text_of
from corpuscope.model import DOC_ARRAY, doc, no_docs, warning

PARSED = T.StructType(
    [
        T.StructField("status", T.StringType()),  # ok | unexpected
        T.StructField("error", T.StringType()),
        T.StructField("plain_imports", T.ArrayType(T.StringType())),
        T.StructField("from_modules", T.ArrayType(T.StringType())),
        T.StructField(
            "functions",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("docstring", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)


def parse(text: str) -> dict:
    found = {"status": "ok", "plain_imports": [], "from_modules": [], "functions": []}
    try:
        with _warnings.catch_warnings():
            _warnings.simplefilter("ignore")
            tree = ast.parse(text)
        for node in ast.walk(tree):
            match node:
                case ast.Import():
                    found["plain_imports"] += [text_of(a.name) for a in node.names]
                case ast.ImportFrom():  # module is None for "from . import x"
                    found["from_modules"].append(text_of(node.module))
                case ast.FunctionDef():
                    about = text_of(ast.get_docstring(node))
                    found["functions"].append({"name": text_of(node.name), "docstring": about})
    except Exception as problem:
        return {"status": "unexpected", "error": text_of(problem)}
    return found


PARSER = Parser(parse, PARSED)

# Fixed value: text rendered for a function without documentation.
NO_DOCSTRING = "No docstring provided."


def imports(parsed: Column) -> Column:
    """Distinct imported modules, sorted; purely relative imports are left out."""
    modules = F.filter(parsed["from_modules"], lambda m: m.isNotNull() & (m != ""))
    return F.array_sort(F.array_union(parsed["plain_imports"], modules))


def function_document(function: Column) -> Column:
    docstring = F.coalesce(F.nullif(function["docstring"], F.lit("")), F.lit(NO_DOCSTRING))
    return doc(
        kind=F.lit("function"),
        page_content=F.concat(F.lit("Function '"), function["name"], F.lit("': "), docstring),
        function_name=function["name"],
    )


def derived_documents(parsed: Column) -> Column:
    summary = doc(
        kind=F.lit("python_summary"),
        content_type=F.lit("python_summary"),
        page_content=F.concat(
            F.lit("This Python script imports the following libraries: "),
            F.array_join(imports(parsed), ", "),
            F.lit("."),
        ),
    )
    functions = F.transform(parsed["functions"], function_document)
    return F.when(
        parsed["status"] == "ok", F.concat(F.array(summary), functions)
    ).otherwise(no_docs()).cast(DOC_ARRAY)


def documents(content: Column, parsed: Column) -> Column:
    raw = doc(kind=F.lit("raw"), page_content=content)
    return F.concat(F.array(raw), derived_documents(parsed))


def warnings(parsed: Column) -> Column:
    return F.when(
        parsed["status"] != "ok", F.array(warning(parsed["status"], parsed["error"]))
    ).otherwise(no_docs())
