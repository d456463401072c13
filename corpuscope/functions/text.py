"""Text helpers shared by the processors. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space when stripping.
WHITESPACE = r"\s\x1c-\x1f\u0085   -     　"
# Look-behind: a run of blanks is tried once, so long runs stay linear.
STRIP_PATTERN = rf"\A[{WHITESPACE}]++|(?<![{WHITESPACE}])[{WHITESPACE}]++\z"
# Fixed value: leading dots of a file name never start an extension.
EXTENSION_PATTERN = r"^\.*[^.].*?(\.[^.]*)$"
# Fixed value: anything that is neither letter, digit nor underscore separates terms.
TERM_SEPARATOR = r"[^\p{L}\p{N}_]+"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, STRIP_PATTERN, "")


def unix_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Suffix used for dispatch; empty for names such as ``.yaml``."""
    return F.regexp_extract(file_name(path), EXTENSION_PATTERN, 1)


def has_suffix(path: Column, suffixes: tuple[str, ...]) -> Column:
    """Allow-list test on the file name, case-sensitive."""
    keep = F.lit(False)
    for suffix in suffixes:
        keep = keep | F.endswith(path, F.lit(suffix))
    return keep


def terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), TERM_SEPARATOR), "")


def given(option: Column, default: str) -> Column:
    """Text of an optional attribute: default if the key is missing, the word
    ``None`` if it is there without a value."""
    return F.when(option["present"], F.coalesce(option["value"], F.lit("None"))).otherwise(
        F.lit(default)
    )


def given_or_null(option: Column, default: str) -> Column:
    """Metadata value of an optional attribute: an explicit null stays null."""
    return F.when(option["present"], option["value"]).otherwise(F.lit(default))
