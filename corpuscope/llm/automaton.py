"""One deterministic automaton for many byte patterns.

Patterns know literals, ``\\xHH`` and escaped characters, classes, groups, ``|``, ``?``,
``*``, ``+``, ``{n}`` and ``{n,}``. They become a nondeterministic automaton, subset
construction searches for all of them at every place at once, and partition refinement
leaves the smallest automaton that reports the same sets of patterns. Bytes no pattern
tells apart share a column of the transition array.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class _Builder:
    """States of the nondeterministic automaton: moves[s] = [(bytes, to)], free[s] = [to]."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def turn(self) -> None:
        """Every move and free move the other way round."""
        moves, free = self.moves, self.free
        self.moves, self.free = [[] for _ in moves], [[] for _ in free]
        for state, out in enumerate(moves):
            for chosen, to in out:
                self.moves[to].append((chosen, state))
        for state, out in enumerate(free):
            for to in out:
                self.free[to].append(state)

    def pattern(self, text: str) -> tuple[int, int]:
        self.text, self.at = text, 0
        ends = self._choice()
        if self.at != len(text):
            raise ValueError(f"unexpected {text[self.at]!r} in {text!r}")
        return ends

    def _peek(self) -> str:
        return self.text[self.at] if self.at < len(self.text) else ""

    def _choice(self) -> tuple[int, int]:
        parts = [self._sequence()]
        while self._peek() == "|":
            self.at += 1
            parts.append(self._sequence())
        if len(parts) == 1:
            return parts[0]
        first, last = self.state(), self.state()
        for a, b in parts:
            self.free[first].append(a)
            self.free[b].append(last)
        return first, last

    def _sequence(self) -> tuple[int, int]:
        first = last = self.state()
        while self._peek() not in ("", "|", ")"):
            begin = self.at
            ends = self._atom()
            end = self.at
            least, unbounded, optional = self._repeat()
            for k in range(least):
                a, b = ends if k == 0 else self._again(begin, end)
                self.free[last].append(a)
                last = b
            if unbounded or optional:
                a, b = self._again(begin, end) if least else ends
                join = self.state()
                self.free[last] += [a, join]
                self.free[b].append(join)
                if unbounded:
                    self.free[join].append(a)
                last = join
        return first, last

    def _again(self, begin: int, end: int) -> tuple[int, int]:
        keep, self.at = self.at, begin
        ends = self._atom()
        assert self.at == end
        self.at = keep
        return ends

    def _repeat(self) -> tuple[int, bool, bool]:
        """(least number, without limit, may be missing)"""
        sign = self._peek()
        if sign and sign in "?*+":
            self.at += 1
            return {"?": (0, False, True), "*": (0, True, False), "+": (1, True, False)}[sign]
        if sign == "{":
            close = self.text.index("}", self.at)
            least, comma, most = self.text[self.at + 1 : close].partition(",")
            if most:
                raise ValueError("upper bounds are not supported")
            self.at = close + 1
            return int(least), bool(comma), False
        return 1, False, False

    def _atom(self) -> tuple[int, int]:
        sign = self._peek()
        if sign == "(":
            self.at += 1
            ends = self._choice()
            if self._peek() != ")":
                raise ValueError("open group")
            self.at += 1
            return ends
        chosen = self._class() if sign == "[" else frozenset([self._byte()])
        first, last = self.state(), self.state()
        self.moves[first].append((chosen, last))
        return first, last

    def _byte(self) -> int:
        sign = self.text[self.at]
        self.at += 1
        if sign != "\\":
            return ord(sign)
        sign = self.text[self.at]
        self.at += 1
        if sign == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(sign)

    def _class(self) -> frozenset[int]:
        self.at += 1
        chosen: set[int] = set()
        while self._peek() != "]":
            low = self._byte()
            high = low
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                high = self._byte()
            chosen.update(range(low, high + 1))
        self.at += 1
        return frozenset(chosen)


@dataclass(frozen=True)
class Automaton:
    columns: np.ndarray  #: byte -> column, uint8
    step: np.ndarray  #: state * width + column -> state, int32
    width: int
    found: np.ndarray  #: state -> bits of the patterns that end here, uint32
    resets: np.ndarray  #: byte -> whether it leads to the start from everywhere
    dead: int  #: state that nothing leads out of, or -1


def compiled(patterns: list[str], anchored: bool = False, backward: bool = False) -> Automaton:
    """Searches at every place, or with ``anchored`` only at the first. With ``backward`` it reads
    from right to left and reports where matches begin."""
    builder = _Builder()
    root = builder.state()
    final = {}
    firsts = []
    for k, text in enumerate(patterns):
        first, last = builder.pattern(text)
        firsts.append(last if backward else first)
        final[first if backward else last] = 1 << k
    if backward:
        builder.turn()
    builder.free[root] += firsts

    sets = list(dict.fromkeys(c for moves in builder.moves for c, _ in moves))
    told = [tuple(b in s for s in sets) for b in range(256)]
    number = {t: k for k, t in enumerate(dict.fromkeys(told))}
    columns = np.array([number[t] for t in told], dtype=np.uint8)
    sample = [int(np.flatnonzero(columns == k)[0]) for k in range(len(number))]

    def closure(states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for to in builder.free[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        # What has no move and ends no pattern tells nothing.
        return frozenset(s for s in seen if builder.moves[s] or s in final)

    start = closure({root})
    rows: list[list[int]] = []
    known, todo = {start: 0}, [start]
    for states in todo:
        row = []
        for b in sample:
            target = closure({t for s in states for c, t in builder.moves[s] if b in c})
            target = target if anchored else target | start
            if target not in known:
                known[target] = len(todo)
                todo.append(target)
            row.append(known[target])
        rows.append(row)
    step = np.array(rows)
    found = np.array([sum({final.get(s, 0) for s in states}) for states in todo], dtype=np.uint32)

    _, block = np.unique(found, return_inverse=True)
    while True:
        _, finer = np.unique(np.c_[block, block[step]], axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    # The start is state 0.
    order = np.unique(block, return_index=True)[1]
    rank = np.empty(len(order), dtype=np.int64)
    rank[np.argsort(order)] = np.arange(len(order))
    block = rank[block]
    step = block[step[np.sort(order)]]
    found = found[np.sort(order)]
    stuck = np.flatnonzero((step == np.arange(len(step))[:, None]).all(axis=1) & (found == 0))
    return Automaton(
        columns,
        step.astype(np.int32).ravel(),
        step.shape[1],
        found,
        (step == 0).all(axis=0)[columns],
        int(stuck[0]) if anchored and len(stuck) else -1,
    )


class Spans:
    """Spans of several patterns, read off transition arrays: leftmost, longest, without overlap.

    One pass from right to left tells where matches begin; from the first beginning not yet
    passed an anchored automaton of the pattern alone runs on to the last place it can end at.
    """

    def __init__(self, patterns: list[str]):
        self.back = _Listed(compiled(patterns, backward=True))
        self.ahead = [_Listed(compiled([p], anchored=True)) for p in patterns]

    def __call__(self, data: bytes, begin: int, end: int, wanted: int):
        """(start, pattern, end) of the patterns whose bits are in ``wanted``."""
        starts: dict[int, list[int]] = {k: [] for k in range(len(self.ahead)) if wanted >> k & 1}
        step, columns, width, found = self.back.parts
        state = 0
        for at in range(end - 1, begin - 1, -1):
            state = step[state * width + columns[data[at]]]
            hit = found[state] & wanted
            while hit:
                starts[(hit & -hit).bit_length() - 1].append(at)
                hit &= hit - 1
        for k, places in starts.items():
            passed = begin
            for at in reversed(places):
                if at >= passed:
                    passed = self.ahead[k].longest(data, at, end)
                    yield at, k, passed


class _Listed:
    """An automaton as lists, for one text at a time."""

    def __init__(self, machine: Automaton):
        self.dead = machine.dead
        self.parts = (
            machine.step.tolist(), machine.columns.tolist(), machine.width, machine.found.tolist(),
        )

    def longest(self, data: bytes, at: int, end: int) -> int:
        """Last place behind ``at`` where the pattern ends, or ``at``."""
        step, columns, width, found = self.parts
        state, last = 0, at
        for place in range(at, end):
            state = step[state * width + columns[data[place]]]
            if state == self.dead:
                break
            if found[state]:
                last = place + 1
        return last


def scan(machine: Automaton, data: np.ndarray, lane: int = 1024, most: int = 4096):
    """(start, end, bits) of the lanes of ``data`` in which patterns end.

    The buffer is cut behind bytes after which nothing can go on, into lanes of about
    equal length that take each step together; every byte is read once. Lanes longer than
    ``most`` are cut anywhere. The parts start as if nothing had gone before; where the part in
    front ends in another state, a part is read again up to where both ways agree.
    """
    columns = machine.columns[data]
    stops = np.flatnonzero(machine.resets[data]) + 1
    wanted = np.searchsorted(stops, np.arange(lane, len(data), lane))
    cuts = np.unique(np.r_[0, stops[wanted[wanted < len(stops)]], len(data)])
    begin, size = cuts[:-1], np.diff(cuts)
    parts = -(-size // most)
    owner = np.repeat(np.arange(len(begin)), parts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = begin[owner] + number * most
    length = np.minimum(most, size[owner] - number * most)
    order = np.argsort(-length, kind="stable")
    at, left = start[order], length[order]
    state = np.zeros(len(at), dtype=np.int32)
    bits = np.zeros(len(at), dtype=np.uint32)
    # States in the first steps of parts that follow others.
    later = number[order] > 0
    trail = np.full((AGREE, int(later.sum())), -1, dtype=np.int32)
    active = np.searchsorted(-left, -np.arange(left[0] if len(left) else 0), side="left")
    for t, n in enumerate(active):
        now = machine.step[state[:n] * machine.width + columns[at[:n] + t]]
        state[:n] = now
        bits[:n] |= machine.found[now]
        if t < AGREE and trail.shape[1]:
            held = later[:n]
            trail[t, : int(held.sum())] = now[held]
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.arange(len(order))
    state, bits = state[back], bits[back]
    if trail.shape[1]:
        _mend(machine, columns, start, length, number, state, bits, trail, back, later)
    found = np.bitwise_or.reduceat(bits, np.cumsum(parts) - parts) if len(begin) else bits
    hit = np.flatnonzero(found)
    return begin[hit], begin[hit] + size[hit], found[hit]


#: Steps in which a part read again may agree with its first reading.
AGREE = 64


def _mend(machine, columns, start, length, number, state, bits, trail, back, later) -> None:
    """Reads parts again whose predecessor does not end in the start."""
    place = np.cumsum(later) - 1
    step, found, width = machine.step.tolist(), machine.found.tolist(), machine.width
    for p in np.flatnonzero(number > 0).tolist():
        now = int(state[p - 1])
        if not now:
            continue
        first = trail[:, place[back[p]]].tolist()
        seen = 0
        for t, column in enumerate(columns[start[p] : start[p] + length[p]].tolist()):
            now = step[now * width + column]
            seen |= found[now]
            if t < AGREE and now == first[t]:
                break
        else:
            state[p] = now
        bits[p] |= np.uint32(seen)
