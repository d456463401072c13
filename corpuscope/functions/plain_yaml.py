"""YAML texts of the plainest kind, read line by line: block mappings of quoted texts.

Most workflow files are of that kind, and a general parser takes twenty times as long for them. A line is
``key:``, ``key: "text"``, ``key: {}`` or ``- "text"``, keys are quoted or lower-case words, texts are
ASCII without escapes. For anything else ``read`` returns None, and the caller takes the general parser.
"""

from __future__ import annotations

import re

_OTHER = re.compile(r"[^\n -~]")
#: Indentation, item with its quotes, quoted key, bare key, quoted text, empty mapping. Keys are short: a
#: general parser has a limit for them.
_LINE = re.compile(
    r'( {0,60})(?:- ("[^"\\]*")|(?:("[^"\\]{0,500}")|([a-z][a-z_]{0,500})):(?: (?:("[^"\\]*")|(\{\})))?)'
)
#: So many lines of up to this length are remembered: most lines of a file are in many others as well.
_MANY, _SHORT = 1 << 14, 100
_seen: dict[str, tuple | None] = {}
#: Bare words that do not stand for themselves.
_MEANING = {"yes", "no", "on", "off", "true", "false", "null"}


def read(text: str) -> list | None:
    """All documents of a text as dicts, lists, texts and None, or None."""
    if not text or _OTHER.search(text):
        return None
    lines = text.split("\n")
    if not lines[-1]:
        lines.pop()
    out, start = [], 0
    ends = [n for n, line in enumerate(lines) if line == "---"]
    for end in [*ends, len(lines)]:
        found = _document(lines[start:end])
        if found is None:
            return None
        out.append(found)
        start = end + 1
    return out


def _parts(line: str) -> tuple | None:
    match = _LINE.fullmatch(line)
    parts = match and match.groups()
    if len(line) <= _SHORT:
        if len(_seen) >= _MANY:
            _seen.clear()
        _seen[line] = parts
    return parts


def _document(lines: list[str]) -> dict | None:
    """One document, a mapping that is not empty."""
    if not lines:
        return None
    root: dict = {}
    #: Open collections with their indentation, and the key that waits for its value.
    opened: list[tuple[int, dict | list]] = [(0, root)]
    at, held = 0, root
    waiting: str | None = None
    for line in lines:
        parts = _seen.get(line) or _parts(line)
        if parts is None:
            return None
        blank, item, quoted, bare, value, empty = parts
        indent = len(blank)
        if indent > at:
            if waiting is None:
                return None
            child: dict | list = [] if item else {}
            held[waiting] = child
            at, held = indent, child
            opened.append((at, held))
        elif indent < at:
            while at > indent:
                opened.pop()
                at, held = opened[-1]
            if at != indent:
                return None
        if item:
            if type(held) is dict:
                return None
            held.append(item[1:-1])
            waiting = None
            continue
        if type(held) is list or bare in _MEANING:
            return None
        key = bare or quoted[1:-1]
        if value:
            held[key], waiting = value[1:-1], None
        elif empty:
            held[key], waiting = {}, None
        else:
            held[key], waiting = None, key
    return root
