"""Files to documents: one scan, one Python stage, one explode, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscope.config import EngineConfig
from corpuscope.functions.parsing import Parser, with_parsed
from corpuscope.functions.text import extension, has_suffix, unix_newlines
from corpuscope.model import (
    DOC_ARRAY,
    DOC_FIELDS,
    WARNING_KIND,
    Wanted,
    explode_documents,
    no_docs,
    warning,
)
from corpuscope.operators import chunks, dictionary, lineage, pycode, workflows
from corpuscope.plans.table_functions import table_documents
from corpuscope.sources.repo_files import read_repository

# Key of the processor for every extension that has none of its own.
FALLBACK = "*"


@dataclass(frozen=True)
class Processor:
    """How files of one extension become documents.

    ``documents(path, content, parsed)`` builds an array of document structs
    from columns; ``parser`` fills ``parsed`` where built-in functions do not do.
    """

    documents: Callable[[Column, Column, Column], Column]
    warnings: Callable[[Column], Column] | None = None
    parser: Parser | None = None
    # False: a file that cannot be read is left out without a warning.
    reports_unreadable: bool = True
    # True: the text itself is in no document but the raw one; all else comes from the parser.
    text_is_raw_only: bool = False
    # True: ``documents`` takes as a fourth what is wanted, and puts null for other documents.
    selective: bool = False


def default_processors(config: EngineConfig = EngineConfig()) -> dict[str, Processor]:
    return {
        ".yaml": Processor(
            workflows.documents, workflows.warnings, workflows.PARSER, text_is_raw_only=True,
            selective=True,
        ),
        ".json": Processor(
            lambda path, content, parsed: dictionary.documents(content, parsed),
            dictionary.warnings,
            dictionary.PARSER,
            text_is_raw_only=True,
        ),
        ".sql": Processor(lambda path, content, parsed: lineage.documents(content)),
        ".py": Processor(
            lambda path, content, parsed: pycode.documents(content, parsed),
            pycode.warnings,
            pycode.PARSER,
            text_is_raw_only=True,
        ),
        FALLBACK: Processor(
            lambda path, content, parsed: chunks.documents(parsed),
            parser=chunks.parser(config.chunk_size, config.chunk_overlap),
            reports_unreadable=False,
            text_is_raw_only=True,
        ),
    }


def with_extension(files: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    """Allow-listed files with their dispatch extension and normalised text."""
    kept = files.where(has_suffix(F.col("path"), suffixes))
    present = set(files.columns)
    return kept.select(
        "path",
        extension(F.col("path")).alias("ext"),
        unix_newlines(F.col("content")).alias("content"),
        (F.col("status") if "status" in present else F.lit("ok")).alias("status"),
        (F.col("error") if "error" in present else F.lit(None).cast("string")).alias("error"),
    )


def ingest(
    files: DataFrame,
    config: EngineConfig = EngineConfig(),
    processors: Mapping[str, Processor | type] | None = None,
    kinds: tuple[str, ...] | None = None,
    fields: tuple[str, ...] | None = None,
) -> DataFrame:
    """Document rows and warning rows (kind ``warning``) of all files.

    A processor may also be a Python table function (``table_functions.py``). With ``kinds`` only
    documents of these kinds are looked for: others are not built, and texts that no such document
    needs are left behind by the parsing stage. Positions in a file are the same. With ``fields``
    only these and the kind come back of a document.
    """
    registry = dict(processors or default_processors(config))
    files = with_extension(files, config.extensions)
    functions = {k: registry.pop(k) for k, p in list(registry.items()) if isinstance(p, type)}
    parts = [table_documents(files.where(F.col("ext") == k), p) for k, p in functions.items()]
    if registry:
        others = files.where(~F.col("ext").isin(list(functions))) if functions else files
        wanted = Wanted(kinds, None if fields is None else ("kind", *fields))
        bare = not (wanted.kind("raw") and wanted.field("page_content"))
        bare = bare and all(p.parser and p.text_is_raw_only for p in registry.values())
        parts.append(_ingest(others, registry, wanted, bare))
    rows = reduce(DataFrame.unionByName, parts)
    if fields is not None:
        kept = [f for f in DOC_FIELDS if f == "kind" or f in fields]
        rows = rows.select("row_id", "source", "ordinal", *kept)
    if kinds is None:
        return rows
    return rows.where(F.col("kind").isin(*kinds, WARNING_KIND))


def _ingest(
    files: DataFrame, registry: dict[str, Processor], wanted: Wanted, bare: bool
) -> DataFrame:
    fallback = registry.pop(FALLBACK, None)
    # The key a file is dispatched on; the fallback takes everything else.
    key = F.when(F.col("ext").isin(list(registry)), F.col("ext")).otherwise(F.lit(FALLBACK))
    files = files.withColumn("ext", key)
    everything = registry | ({FALLBACK: fallback} if fallback else {})

    parsers = {k: p.parser for k, p in everything.items() if p.parser}
    if bare:
        kept = tuple(c for c in files.columns if c != "content")
        parsed = with_parsed(files, parsers, kept).withColumn("content", F.lit("").cast("string"))
    else:
        parsed = with_parsed(files, parsers) if parsers else files
    field = {k: F.col(f"parsed.p{i}") for i, k in enumerate(parsers)}
    nothing = F.lit(None)

    docs, unreadable = None, None
    for k, p in everything.items():
        part = field.get(k, nothing)
        built = p.documents(
            F.col("path"), F.col("content"), part, *([wanted] if p.selective else [])
        ).cast(DOC_ARRAY)
        if p.warnings:
            built = F.concat(built, p.warnings(part).cast(DOC_ARRAY))
        here = F.col("ext") == k
        docs = F.when(here, built) if docs is None else docs.when(here, built)
        if p.reports_unreadable:
            unreadable = here if unreadable is None else unreadable | here
    problem = F.array(warning(F.col("status"), F.col("error"))).cast(DOC_ARRAY)
    silent = no_docs() if unreadable is None else F.when(unreadable, problem).otherwise(no_docs())
    rows = F.when(F.col("status") == "ok", docs.otherwise(no_docs())).otherwise(silent)
    return explode_documents(parsed, rows)


def documents(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("kind") != WARNING_KIND)


def ingest_warnings(rows: DataFrame) -> DataFrame:
    """``path, class, message`` of everything that went wrong in a file."""
    return rows.where(F.col("kind") == WARNING_KIND).select(
        F.col("source").alias("path"),
        F.col("content_type").alias("class"),
        F.col("page_content").alias("message"),
    )


def ingest_repository(
    spark: SparkSession,
    root: str,
    config: EngineConfig = EngineConfig(),
    processors: Mapping[str, Processor] | None = None,
) -> DataFrame:
    files = read_repository(spark, root, config.extensions, config.read_partitions)
    return ingest(files, config, processors)
