"""Overlapping text chunks.

``windows`` cuts text that has no separators. ``recursive`` prefers paragraph, line and word
borders; a text is split at the coarsest border, pieces that are too long at the next one,
and runs of the others are packed by a fold that carries where the chunk begins. Both stay in the
JVM. ``split`` is the same in Python, on offsets into the text of one file.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscope.config import CHUNK_OVERLAP, CHUNK_SIZE
from corpuscope.functions.arrays import let
from corpuscope.functions.parsing import Parser
from corpuscope.functions.text import strip
from corpuscope.model import DOC_ARRAY, doc, no_docs

# Borders tried from coarse to fine; after them single characters.
BORDERS = ("\n\n", "\n", " ")


def windows(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """``array<string>`` of windows of ``size`` characters that share ``overlap``.

    The text is cut once into steps; a window is a step plus the head of the
    next, so the work is linear in the text.
    """
    step = size - overlap
    if not 0 <= overlap <= step:
        raise ValueError("overlap must not exceed half of the chunk size")

    def join(steps: Column) -> Column:
        tail = F.get(steps, F.size(steps) - 1)
        # A last step that fits into the overlap is already in the window before.
        covered = (F.size(steps) > 1) & (F.char_length(tail) <= overlap)
        whole = F.transform(
            steps,
            lambda s, i: F.concat(
                s, F.coalesce(F.left(F.get(steps, i + 1), F.lit(overlap)), F.lit(""))
            ),
        )
        return F.slice(whole, F.lit(1), F.size(steps) - covered.cast("int"))

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0)), join)


def _cuts(text: str, begin: int, end: int, border: str) -> list[int]:
    """Start offsets of the pieces of text[begin:end]; a border opens a piece."""
    starts = (m.start() for m in re.compile(re.escape(border)).finditer(text, begin, end))
    return [begin] + [s for s in starts if s > begin] + [end]


def _pack(sizes_end: list[int], size: int, overlap: int):
    """Greedy spans over consecutive pieces, given as a list of offsets.

    Yields (from, to) offsets. Each span is at most ``size`` long and repeats at
    most ``overlap`` trailing characters of the one before.
    """
    first = 0
    for last in range(1, len(sizes_end)):
        begin, new_end = sizes_end[last - 1], sizes_end[last]
        if new_end - sizes_end[first] > size and first < last - 1:
            yield sizes_end[first], begin
            while first < last - 1 and (
                begin - sizes_end[first] > overlap or new_end - sizes_end[first] > size
            ):
                first += 1
    if len(sizes_end) > 1:
        yield sizes_end[first], sizes_end[-1]


def _spans(text: str, begin: int, end: int, level: int, size: int, overlap: int):
    while level < len(BORDERS) and text.find(BORDERS[level], begin, end) < 0:
        level += 1
    if level == len(BORDERS):
        if end - begin > 0:
            step = size - overlap
            at = begin
            while True:
                yield at, min(at + size, end)
                if at + size >= end:
                    return
                at += step
        return
    offsets = _cuts(text, begin, end, BORDERS[level])
    pending = [offsets[0]]
    for left, right in zip(offsets, offsets[1:]):
        if right - left < size:
            pending.append(right)
            continue
        yield from _pack(pending, size, overlap)
        pending = [right]
        yield from _spans(text, left, right, level + 1, size, overlap)
    yield from _pack(pending, size, overlap)


def split(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> list[str]:
    """Chunks of at most ``size`` characters, outer white space removed."""
    pieces = (text[a:b].strip() for a, b in _spans(text, 0, len(text), 0, size, overlap))
    return [p for p in pieces if p]


def parser(size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Parser:
    return Parser(lambda text: split(text, size, overlap), T.ArrayType(T.StringType()))


def _pieces(text: Column, border: str) -> Column:
    """Parts of a text; a border opens a part."""

    def opened(parts: Column) -> Column:
        whole = F.transform(
            parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit(border), p))
        )
        return F.when(
            F.get(parts, F.lit(0)) == "", F.slice(whole, F.lit(2), F.size(whole))
        ).otherwise(whole)

    return let(F.split(text, border, -1), opened)


def _packed(pieces: Column, size: int, overlap: int) -> Column:
    """Chunks of consecutive pieces, each shorter than ``size``."""

    def fold(lengths: Column) -> Column:
        def step(state: Column, last: Column) -> Column:
            begin = state["end"]
            end = begin + F.get(lengths, last - 1)
            full = (end - state["from"] > size) & (state["first"] < last - 1)

            def later(s: Column, length: Column) -> Column:
                far = (begin - s["from"] > overlap) | (end - s["from"] > size)
                return F.when(
                    far,
                    F.struct((s["first"] + 1).alias("first"), (s["from"] + length).alias("from")),
                ).otherwise(s)

            # Only pieces of the chunk that is full are looked at again.
            moved = F.aggregate(
                F.slice(lengths, state["first"] + 1, last - 1 - state["first"]),
                F.struct(state["first"].alias("first"), state["from"].alias("from")),
                later,
            )
            span = F.struct(state["first"].alias("first"), (last - 1).alias("last"))
            same = F.struct(
                state["first"].alias("first"), state["from"].alias("from"), end.alias("end"),
                state["spans"].alias("spans"),
            )
            return F.when(
                full,
                let(
                    moved,
                    lambda m: F.struct(
                        m["first"].alias("first"), m["from"].alias("from"), end.alias("end"),
                        F.concat(state["spans"], F.array(span)).alias("spans"),
                    ),
                ),
            ).otherwise(same)

        none = F.array().cast("array<struct<first:int,last:int>>")
        zero = F.lit(0)
        start = F.struct(
            zero.alias("first"), zero.alias("from"), zero.alias("end"), none.alias("spans")
        )
        n = F.size(pieces)

        def spans(state: Column) -> Column:
            rest = F.struct(state["first"].alias("first"), n.alias("last"))
            return F.concat(state["spans"], F.array(rest))

        found = F.aggregate(F.sequence(F.lit(1), n), start, step, spans)
        return F.transform(
            found,
            lambda s: F.array_join(F.slice(pieces, s["first"] + 1, s["last"] - s["first"]), ""),
        )

    return let(F.transform(pieces, F.char_length), fold)


def _level(text: Column, level: int, size: int, overlap: int) -> Column:
    """Chunks of a text that may be split at the borders from ``level`` on."""
    if level == len(BORDERS):
        return windows(text, size, overlap)

    def grouped(pieces: Column) -> Column:
        n = F.size(pieces)
        long = lambda k: F.char_length(F.get(pieces, k)) >= size
        starts = F.filter(
            F.sequence(F.lit(0), n - 1), lambda k: (k == 0) | long(k) | long(k - 1)
        )

        def chunks_of(begin: Column, end: Column) -> Column:
            first = F.get(pieces, begin)
            return F.when(
                F.char_length(first) >= size, _level(first, level + 1, size, overlap)
            ).otherwise(let(F.slice(pieces, begin + 1, end - begin), lambda p: _packed(p, size, overlap)))

        return let(
            starts,
            lambda s: F.flatten(
                F.transform(s, lambda b, i: chunks_of(b, F.coalesce(F.get(s, i + 1), n)))
            ),
        )

    return let(_pieces(text, BORDERS[level]), grouped)


def recursive(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """``array<string>`` as ``split`` gives it, without leaving the JVM."""
    found = F.when(F.char_length(text) > 0, _level(text, 0, size, overlap)).otherwise(
        F.array().cast("array<string>")
    )
    return F.filter(F.transform(found, strip), lambda c: c != "")


def documents(parsed: Column) -> Column:
    chunks = F.transform(parsed, lambda c: doc(kind=F.lit("chunk"), page_content=c))
    return F.coalesce(chunks.cast(DOC_ARRAY), no_docs())
