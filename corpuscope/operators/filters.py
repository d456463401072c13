"""Metadata filters of a question.

A filter is a small value, e.g. ``{"and": [{"eq": ["owner", "ana"]}, {"in":
["kind", ["dag_task", "raw"]]}]}``. It becomes a Column when it holds for all
questions, or travels as JSON with each question.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import and_, eq, ge, gt, le, lt, ne, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {"eq": eq, "ne": ne, "lt": lt, "lte": le, "gt": gt, "gte": ge}


def to_column(spec: dict, allowed: tuple[str, ...] | None = None) -> Column:
    """Predicate for ``where``; pushes down to the scan. Null never matches."""
    (name, argument), = spec.items()
    if name in ("and", "or"):
        parts = [to_column(part, allowed) for part in argument]
        return reduce(and_ if name == "and" else or_, parts)
    attribute, value = argument
    if allowed is not None and attribute not in allowed:
        raise ValueError(f"cannot filter on {attribute!r}")
    if name == "in":
        return F.col(attribute).isin(list(value))
    if name not in _COMPARE:
        raise ValueError(f"unknown comparison {name!r}")
    return _COMPARE[name](F.col(attribute), F.lit(value))


def problem(text: str | None, types: dict[str, str]) -> str | None:
    """Why a filter in JSON cannot be used on columns of these Spark types, or None."""
    if not text:
        return None
    try:
        spec = json.loads(text)
    except ValueError:
        return "filter is not JSON"
    return _problem(spec, types)


def _problem(spec, types: dict[str, str]) -> str | None:
    if not isinstance(spec, dict) or len(spec) != 1:
        return "a filter is an object with one key"
    (name, argument), = spec.items()
    if name in ("and", "or"):
        if not isinstance(argument, list) or not argument:
            return f"{name!r} needs a list of filters"
        return next((p for p in (_problem(part, types) for part in argument) if p), None)
    if name != "in" and name not in _COMPARE:
        return f"unknown comparison {name!r}"
    if not isinstance(argument, list) or len(argument) != 2:
        return f"{name!r} needs an attribute and a value"
    attribute, value = argument
    if attribute not in types:
        return f"cannot filter on {attribute!r}"
    values = value if name == "in" else [value]
    if not isinstance(values, list):
        return "'in' needs a list of values"
    text_wanted = types[attribute] == "string"
    whole = types[attribute] in ("tinyint", "smallint", "int", "bigint")
    for v in values:
        fits = isinstance(v, str) if text_wanted else isinstance(v, int if whole else (int, float))
        if not fits or isinstance(v, bool) != (types[attribute] == "boolean"):
            return f"value of {attribute!r} is not of type {types[attribute]}"
    return None


def to_json(spec: dict | None) -> str | None:
    return None if spec is None else json.dumps(spec, sort_keys=True)
