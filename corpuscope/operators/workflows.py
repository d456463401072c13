"""Workflow (DAG) definitions in YAML: summaries, tasks, dependency edges.

Python only turns the text into typed structs, with the neighbours of each task by the
flows. Everything after that is row-local array work: one file is one row, so neither edges nor
neighbour lists need a shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import pairwise

import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscope.functions import budget, plain_yaml
from corpuscope.functions.arrays import let
from corpuscope.functions.parsing import OPTION, Parser, option, text_of
from corpuscope.functions.text import given, given_or_null, strip
from corpuscope.model import DOC_ARRAY, Wanted, doc, no_doc, no_docs, warning

TASK = T.StructType(
    [
        T.StructField("name", T.StringType()),  # as rendered in text
        T.StructField("label", T.StringType()),  # null for a null key
        T.StructField("flow_key", T.StringType()),  # null unless the key is a string
        T.StructField("operator", OPTION),
        T.StructField("file", OPTION),
        T.StructField("before", T.ArrayType(T.StringType())),  # tasks that run before it
        T.StructField("after", T.ArrayType(T.StringType())),
    ]
)
DAG = T.StructType(
    [
        T.StructField("doc_idx", T.IntegerType()),
        T.StructField("error", T.StringType()),
        T.StructField("dag_id", OPTION),
        T.StructField("owner", OPTION),
        T.StructField("schedule", OPTION),
        T.StructField("description", OPTION),
        T.StructField("tasks", T.ArrayType(TASK)),
        T.StructField("execution", T.ArrayType(T.StringType())),
    ]
)
PARSED = T.StructType(
    [
        T.StructField("status", T.StringType()),  # ok | invalid_syntax | too_large | unexpected
        T.StructField("error", T.StringType()),
        T.StructField("dags", T.ArrayType(DAG)),
    ]
)

_LOADER = getattr(yaml, "CSafeLoader", yaml.SafeLoader)


def _mapping(value, what: str) -> dict:
    if not isinstance(value, dict):
        raise TypeError(f"{what} is not a mapping")
    return value


def _neighbours(flows: list[str]) -> tuple[dict, dict]:
    """Of each name in a flow those before and after it, in the order of the flows."""
    before, after = defaultdict(list), defaultdict(list)
    for flow in flows:
        names = [name.strip() for name in flow.split(">>")]
        for up, down in pairwise(names):
            before[down].append(up)
            after[up].append(down)
    return before, after


def _task(key, details, before: dict, after: dict) -> dict:
    details = _mapping(details, f"task {key!r}")
    # A task whose key is not text can never be named by a flow.
    flow_key = text_of(key) if isinstance(key, str) else None
    return {
        "name": text_of(str(key)),
        "label": text_of(key),
        "flow_key": flow_key,
        "operator": option(details, "operator"),
        "file": option(details, "file"),
        "before": before.get(flow_key, ()),
        "after": after.get(flow_key, ()),
    }


def _dag(index: int, content: dict) -> dict:
    try:
        info = _mapping(content["dag"], "dag")
        flows = content.get("execution")
        flows = flows if isinstance(flows, list) else []
        if not all(isinstance(flow, str) for flow in flows):
            raise TypeError("execution holds something that is not text")
        flows = [text_of(flow) for flow in flows]
        near = _neighbours(flows)
        tasks = _mapping(content.get("tasks", {}), "tasks")
        return {
            "doc_idx": index,
            "dag_id": option(info, "dag_id"),
            "owner": option(_mapping(info.get("default_args", {}), "default_args"), "owner"),
            "schedule": option(info, "schedule_interval"),
            "description": option(info, "description"),
            "tasks": [_task(k, v, *near) for k, v in tasks.items()],
            "execution": flows,
        }
    except Exception as problem:
        return {"doc_idx": index, "error": text_of(problem)}


def parse(text: str) -> dict:
    try:
        # A plain text has no aliases, and little nesting beside that of its brackets.
        few = text.count("[") + text.count("{") <= budget.DEPTH
        contents = plain_yaml.read(text) if few else None
        if contents is None:
            budget.check(text)
            contents = list(yaml.load_all(text, Loader=_LOADER))
    except budget.TooLarge as problem:
        return {"status": "too_large", "error": text_of(problem), "dags": []}
    except yaml.YAMLError as problem:
        return {"status": "invalid_syntax", "error": text_of(problem), "dags": []}
    except Exception as problem:  # e.g. an impossible date, or too deep nesting
        return {"status": "unexpected", "error": text_of(problem), "dags": []}
    dags = [_dag(i, c) for i, c in enumerate(contents) if isinstance(c, dict) and "dag" in c]
    return {"status": "ok", "error": None, "dags": dags}


PARSER = Parser(parse, PARSED)

# Texts rendered when a key is missing, and the summary's id suffix.
NO_ID = "N/A"
NO_OWNER = "N/A"
NO_SCHEDULE = "N/A"
NO_DESCRIPTION = "No description provided."
NO_OPERATOR = "unknown"
NO_SCRIPT = "not specified"
SUMMARY_ID = "__DAG_SUMMARY__"


def kept_dags(parsed: Column) -> Column:
    """DAGs before the first faulty one; the faulty one and all later are lost."""
    faulty = F.array_min(
        F.transform(
            F.filter(parsed["dags"], lambda d: d["error"].isNotNull()), lambda d: d["doc_idx"]
        )
    )
    return let(
        faulty,
        lambda cut: F.filter(parsed["dags"], lambda d: cut.isNull() | (d["doc_idx"] < cut)),
    )


def edges(dag: Column) -> Column:
    """``array<struct<flow_idx, pair_idx, up, down>>`` in order of appearance."""

    def pairs(flow: Column, flow_idx: Column) -> Column:
        parts = F.transform(F.split(flow, ">>"), strip)
        return let(
            parts,
            lambda p: F.transform(
                F.slice(p, F.lit(1), F.size(p) - 1),
                lambda up, i: F.struct(
                    flow_idx.alias("flow_idx"),
                    i.alias("pair_idx"),
                    up.alias("up"),
                    F.get(p, i + 1).alias("down"),
                ),
            ),
        )

    return F.flatten(F.transform(dag["execution"], pairs))


def _clause(lead: str, names: Column) -> Column:
    return F.when(
        F.size(names) > 0, F.concat(F.lit(lead), F.array_join(names, ", "), F.lit("."))
    ).otherwise(F.lit(""))


def dag_documents(dag: Column, wanted: Wanted = Wanted()) -> Column:
    """Summary document followed by one document per task, in file order.

    What is not wanted keeps its place as null.
    """
    dag_id = given(dag["dag_id"], NO_ID)
    owner = given(dag["owner"], NO_OWNER)
    schedule = given(dag["schedule"], NO_SCHEDULE)
    description = given(dag["description"], NO_DESCRIPTION)
    shared = {
        "dag_id": given_or_null(dag["dag_id"], NO_ID),
        "owner": given_or_null(dag["owner"], NO_OWNER),
        "schedule": given_or_null(dag["schedule"], NO_SCHEDULE),
        "dag_description": given_or_null(dag["description"], NO_DESCRIPTION),
    }
    # Sentence templates.
    summary = doc(
        wanted,
        kind=F.lit("dag_summary"),
        doc_id=F.concat(dag_id, F.lit(":" + SUMMARY_ID)),
        page_content=F.concat(
            F.lit("This document describes the DAG configuration with ID '"),
            dag_id,
            F.lit("'. The owner is '"),
            owner,
            F.lit("', it runs on schedule: '"),
            schedule,
            F.lit("', and its description is: '"),
            description,
            F.lit("'."),
        ),
        **shared,
    )

    def task_document(task: Column) -> Column:
        return doc(
            wanted,
            kind=F.lit("dag_task"),
            doc_id=F.concat(dag_id, F.lit(":"), task["name"]),
            page_content=F.concat(
                F.lit("The DAG '"),
                dag_id,
                F.lit("' contains a task named '"),
                task["name"],
                F.lit("'. This task uses the '"),
                given(task["operator"], NO_OPERATOR),
                F.lit("' operator and runs the script '"),
                given(task["file"], NO_SCRIPT),
                F.lit("'."),
                _clause(" It runs after the following task(s): ", task["before"]),
                _clause(" It runs before the following task(s): ", task["after"]),
            ),
            task_name=task["label"],
            operator=given_or_null(task["operator"], NO_OPERATOR),
            script_file=given_or_null(task["file"], NO_SCRIPT),
            **shared,
        )

    if wanted.kind("dag_task"):
        tasks = F.transform(dag["tasks"], task_document)
    else:
        tasks = F.array_repeat(no_doc(), F.size(dag["tasks"]))
    return F.concat(F.array(summary if wanted.kind("dag_summary") else no_doc()), tasks)


def raw_document(path: Column, content: Column) -> Column:
    return doc(
        kind=F.lit("raw"), doc_id=F.concat(F.lit("raw:"), path), page_content=content
    )


def derived_documents(parsed: Column, wanted: Wanted = Wanted()) -> Column:
    docs = F.flatten(F.transform(kept_dags(parsed), lambda dag: dag_documents(dag, wanted)))
    return F.coalesce(docs.cast(DOC_ARRAY), no_docs())


def documents(
    path: Column, content: Column, parsed: Column, wanted: Wanted = Wanted()
) -> Column:
    raw = raw_document(path, content) if wanted.kind("raw") else no_doc()
    return F.concat(F.array(raw), derived_documents(parsed, wanted))


def warnings(parsed: Column) -> Column:
    """At most one per file: its syntax problem, or its first faulty DAG."""
    faulty = F.get(F.filter(parsed["dags"], lambda d: d["error"].isNotNull()), F.lit(0))
    return (
        F.when(parsed["status"] != "ok", F.array(warning(parsed["status"], parsed["error"])))
        .when(
            faulty["error"].isNotNull(),
            F.array(warning(F.lit("unexpected"), faulty["error"])),
        )
        .otherwise(no_docs())
    )


def edge_rows(parsed_files: DataFrame, parsed: Column) -> DataFrame:
    """Dependency edges as a table: one row per adjacent pair of a flow."""
    dags = parsed_files.select("path", F.explode(kept_dags(parsed)).alias("dag"))
    return dags.select(
        "path",
        F.col("dag.doc_idx").alias("doc_idx"),
        given(F.col("dag.dag_id"), NO_ID).alias("dag_id"),
        F.explode(edges(F.col("dag"))).alias("e"),
    ).select("path", "doc_idx", "dag_id", "e.*")
