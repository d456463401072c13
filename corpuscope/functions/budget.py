"""What a YAML text would take before it is built: aliases, depth and size.

A few hundred bytes of anchors and aliases can stand for gigabytes, and a few thousand
brackets for a stack that no parser returns from. Both are seen in the stream of events,
which holds one number per open node and per anchor.
"""

from __future__ import annotations

import re

import yaml

#: Deepest nesting, and characters of a text with all aliases written out: so many times its own
#: length, or LEAST.
DEPTH = 200
TIMES = 8
LEAST = 1_000_000

_LOADER = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
_LEADING = re.compile(r"^[ \-?:]*", re.MULTILINE)


class TooLarge(ValueError):
    """A text that would not fit its budget."""


def _suspicious(text: str) -> bool:
    """Whether the events need a look: most texts have no alias and little nesting."""
    if "*" in text and "&" in text:
        return True
    if text.count("[") + text.count("{") > DEPTH:
        return True
    return any(len(m.group()) > DEPTH for m in _LEADING.finditer(text))


def _nesting(text: str) -> int:
    """At most so deep does a text nest: brackets open at once, and what begins a line.

    Brackets inside quoted text count too, but closing ones do not lower the number below
    what is open, so the bound holds; it is only asked whether it passes DEPTH.
    """
    opened = deepest = 0
    for mark in re.findall(r"[\[\]{}]", text):
        opened = opened + 1 if mark in "[{" else max(0, opened - 1)
        deepest = max(deepest, opened)
    return deepest + max((len(m.group()) for m in _LEADING.finditer(text)), default=0)


def check(text: str) -> None:
    """Raises ``TooLarge``; syntax errors are left to the loader."""
    if not _suspicious(text):
        return
    # The loader's own event reader may run out of stack on what is deeper than this.
    if _nesting(text) > 50 * DEPTH:
        raise TooLarge(f"nested deeper than {DEPTH}")
    most = max(LEAST, TIMES * len(text))
    sizes: dict[str, int] = {}
    open_nodes: list[list] = []
    total = 0
    for event in yaml.parse(text, Loader=_LOADER):
        if isinstance(event, yaml.DocumentStartEvent):
            sizes, open_nodes, total = {}, [], 0
            continue
        elif isinstance(event, (yaml.SequenceStartEvent, yaml.MappingStartEvent)):
            open_nodes.append([event.anchor, 2])
            if len(open_nodes) > DEPTH:
                raise TooLarge(f"nested deeper than {DEPTH}")
            continue
        elif isinstance(event, yaml.ScalarEvent):
            size = len(event.value) + 2
            if event.anchor:
                sizes[event.anchor] = size
        elif isinstance(event, yaml.AliasEvent):
            if event.anchor not in sizes:
                # Undefined, or a node inside itself.
                if any(anchor == event.anchor for anchor, _ in open_nodes):
                    raise TooLarge(f"alias {event.anchor!r} holds itself")
                return
            size = sizes[event.anchor]
        elif isinstance(event, (yaml.SequenceEndEvent, yaml.MappingEndEvent)):
            anchor, size = open_nodes.pop()
            if anchor:
                sizes[anchor] = size
        else:
            continue
        if open_nodes:
            open_nodes[-1][1] += size
            held = open_nodes[-1][1]
        else:
            total += size
            held = total
        if held > most:
            raise TooLarge(f"more than {most} characters with aliases written out")
