"""SQL scripts: main query and the tables it reads. JVM-only, row-local."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuscope.functions.arrays import let
from corpuscope.functions.text import strip
from corpuscope.model import doc

# The notebook marker and the wrappers around a main query.
# Each wrapper is (pattern, capture groups); the first that matches wins.
NOTEBOOK_MARKER = "-- Databricks notebook source"
WRAPPERS = (
    (r"unload\s*\(\s*\$\$(.*?)\$\$\s*\)", (1,)),
    (r"create\s+materialized\s+view\s+.*?\s+as\s+(.*)", (1,)),
    (r"create\s+(or\s+replace\s+)?view\s+.*?\s+as\s+(.*)", (2,)),
    (r"create\s+(temp\s+)?table\s+.*?as\s*(\((.*?)\)|(.*))", (3, 4)),
)
# Stricter reading of the last wrapper: AS is a whole word, the body is whole.
STRICT_TABLE = (r"create\s+(temp\s+)?table\s+.*?\bas\b\s*(.*)", (2,))
_FLAGS = "(?isU)"


def clean_script(content: Column) -> Column:
    """Script without notebook markers and outer white space."""
    return strip(F.replace(content, F.lit(NOTEBOOK_MARKER), F.lit("")))


def main_query(script: Column, strict: bool = False) -> Column:
    """Query inside UNLOAD, CREATE ... VIEW or CREATE TABLE; else the whole script.

    By default a parenthesised table body ends at its first ``)`` and ``as`` may
    be the tail of a word. ``strict`` repairs both.
    """
    wrappers = WRAPPERS[:-1] + ((STRICT_TABLE,) if strict else WRAPPERS[-1:])
    result = None
    for pattern, groups in wrappers:
        body = strip(F.concat(*[F.regexp_extract(script, _FLAGS + pattern, g) for g in groups]))
        if strict:
            body = _outer_parentheses_removed(body)
        matches = F.rlike(script, F.lit(_FLAGS + pattern))
        result = F.when(matches, body) if result is None else result.when(matches, body)
    return result.otherwise(script)


def _outer_parentheses_removed(body: Column) -> Column:
    bare = F.regexp_replace(body, r";\s*\z", "")
    wrapped = F.rlike(bare, F.lit(r"(?s)\A\(.*\)\z"))
    return F.when(wrapped, strip(F.regexp_replace(bare, r"\A\(|\)\z", ""))).otherwise(bare)


# --- tables read -----------------------------------------------------------
# Words that end a list of tables.
_BREAKS = (
    "select where on using group order having union intersect except limit offset window "
    "qualify set values when then else end case and or not between in like is asc desc nulls "
    "over within filter returning with recursive lateral cross inner left right full outer "
    "natural semi anti tablesample fetch for"
).split()
# One-character marks for the words that matter, so that the patterns below
# need neither alternation nor backtracking.
_BREAK, _FROM, _JOIN, _TARGET = "\x01", "\x02", "\x03", "\x04"
_MARKS = r"\x01\x02\x03\x04();"
_COMMENT_OR_LITERAL = r"(?s)--[^\n]*|/\*.*?\*/|'[^']*'"
_PART = r'(?:[\p{L}\p{N}_$@{}#-]+|"[^"]+"|`[^`]+`|\[[^\]]+\])'
_NAME = rf"{_PART}(?:\s*\.\s*{_PART})*"
_CTE = (
    rf"(?:\x01|,)\s*({_NAME})(?:\s*\([^()]*\)\s*|\s+)as\s*(?:\x01\s*)?(?:materialized\s*)?\("
)
_FROM_INSIDE_CALL = r"\b(extract|trim|substring|overlay|position)\s*\([^()]*\)"
_SEGMENTS = (
    # after FROM or JOIN, or the one name after INTO / UPDATE / TABLE
    rf"[\x02\x03\x04][^{_MARKS}]*+\(?"
    # further items after a derived table and its alias: ") a, b"; a select
    # list looks the same but is followed by FROM or a call
    rf"|\)\s*(?:as\s+)?[\p{{L}}\p{{N}}_]++\s*+,[^{_MARKS}]*+(?![\x02(])"
)


def _marked(query: Column) -> Column:
    """Query without comments and literals, with clause words as marks."""
    text = F.regexp_replace(query, _COMMENT_OR_LITERAL, " ")
    text = F.regexp_replace(text, r"[\x01-\x04]", " ")
    text = F.regexp_replace(text, "(?i)" + _FROM_INSIDE_CALL, " ")
    text = F.regexp_replace(text, r"(?i)\bdistinct\s+from\b", " ")
    for words, mark in (
        (r"insert\s+overwrite\s+(?:table\s+)?|into\s+(?:table\s+)?", _TARGET),
        (r"(?<!key )update(?=\s+[^;]*?\bset\b)", _TARGET),
        (r"table\s+(?:if\s+(?:not\s+)?exists\s+)?", _TARGET),
        (r"(?:delete\s+)?from\b(?:\s+only\b)?", _FROM),
        (r"join\b", _JOIN),
        (rf"(?:{'|'.join(_BREAKS)})\b", _BREAK),
    ):
        text = F.regexp_replace(text, rf"(?i)(?<![\p{{L}}\p{{N}}_$.\"`])(?:{words})", mark)
    return text


def _bare(name: Column) -> Column:
    return F.regexp_replace(name, r'["`\[\]\s]', "")


def _tables_of_segment(segment: Column) -> Column:
    """Names in one comma list; a trailing ``name(`` is a call, not a table."""
    called = F.endswith(segment, F.lit("("))
    is_target = F.startswith(segment, F.lit(_TARGET))
    # The part before the first comma of a ") alias, ..." segment is the alias.
    body = F.regexp_replace(segment, r"(?s)\A\)[^,]*,|\A[\x02-\x04]|\($", "")

    def name_of(item: Column) -> Column:
        return _bare(F.regexp_extract(item, rf"\A\s*({_NAME})", 1))

    def names(items: Column) -> Column:
        last = F.size(items) - 1
        kept = F.filter(
            items,
            lambda item, i: ~(
                called & ~is_target & (i == last) & ~F.rlike(strip(item), F.lit(r"\s"))
            ),
        )
        return F.filter(F.transform(kept, name_of), lambda n: n != "")

    return let(F.split(body, ","), names)


def tables(query: Column) -> Column:
    """Distinct tables in order of appearance, without common table expressions."""

    def extract(text: Column) -> Column:
        ctes = F.transform(
            F.regexp_extract_all(text, F.lit("(?i)" + _CTE), F.lit(1)), lambda n: F.lower(_bare(n))
        )
        segments = F.regexp_extract_all(text, F.lit(_SEGMENTS), F.lit(0))
        found = F.array_distinct(F.flatten(F.transform(segments, _tables_of_segment)))
        return let(
            ctes, lambda c: F.filter(found, lambda n: ~F.array_contains(c, F.lower(n)))
        )

    return let(_marked(query), extract)


# First words of the statements that are analysed.
STATEMENTS = "select with insert replace create update delete drop alter truncate merge".split()


# Clause words that cannot stand where a table is expected.
_NO_TABLE = "select|from|where|on|using|join|group|order|having|union|intersect|except|limit|set"


def is_query(query: Column) -> Column:
    """Whether the text is a statement with something after each FROM and JOIN."""

    def check(text: Column) -> Column:
        bare = strip(F.regexp_replace(text, r"\A[\s(]+", ""))
        statement = F.rlike(bare, F.lit(rf"(?i)\A(?:{'|'.join(STATEMENTS)})\b"))
        dangling = F.rlike(text, F.lit(rf"(?i)\b(?:from|join)\s*(?:\b(?:{_NO_TABLE})\b|[;)]|\z)"))
        return statement & ~dangling

    return let(F.regexp_replace(query, _COMMENT_OR_LITERAL, " "), check)


def summary_text(names: Column) -> Column:
    # Sentence template.
    listing = F.when(F.size(names) > 0, F.array_join(names, ", ")).otherwise(F.lit("none"))
    return F.concat(
        F.lit("This SQL script reads from the following tables: "), listing, F.lit(".")
    )


def documents(content: Column, strict: bool = False) -> Column:
    def build(script: Column) -> Column:
        raw = doc(kind=F.lit("raw"), page_content=script)

        def analysed(query: Column) -> Column:
            summary = doc(
                kind=F.lit("sql_summary"),
                content_type=F.lit("sql_summary"),
                page_content=let(tables(query), summary_text),
            )
            # A script that cannot be analysed has its text only.
            return F.when(is_query(query), F.array(raw, summary)).otherwise(F.array(raw))

        return let(main_query(script, strict), analysed)

    return let(clean_script(content), build)
