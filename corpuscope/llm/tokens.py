"""Token ids of whole texts by a public tokenizer file, with a memory of words.

The tokenizer splits a text into words first and encodes each alone, so equal words have
equal ids. Texts whose characters fold and split the same way under Python's rules are
split here, and the words of many texts that were not met before go to the tokenizer in
one call. All other texts go to it whole.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import islice

import numpy as np

from corpuscope.llm.common import slices

#: Bytes of words that are remembered, about, and what each has besides its own.
REMEMBERED, OVERHEAD = 72 << 20, 200
#: Words longer than this are not remembered.
LONG = 64
#: Characters of texts that are encoded together.
TOGETHER = 1 << 18
#: Characters below this code point have a lower case below it too, and NFC leaves them.
LAST = 0x180


def _class(kind: str) -> str:
    return "".join(
        re.escape(chr(c)) for c in range(LAST) if unicodedata.category(chr(c)).startswith(kind)
    )


# How the tokenizer file splits, over the characters below LAST.
SPLIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^\\s{_class('L')}{_class('N')}]+"
)
#: White space is told differently for separators, and a dotted capital I grows; "<|" may
#: begin a special token.
SEPARATORS = (b"\x1c", b"\x1d", b"\x1e", b"\x1f", b"<|")
OTHER = re.compile(f"[^\\x00-{chr(LAST - 1)}]|[\\x1c-\\x1f\u0130]|<\\|")
#: Stands between words that are encoded in one call; its id is no part of any other token.
BAR = "|"


def plain(text: str) -> bool:
    """Whether a text may be split under Python's rules."""
    try:
        data = text.encode("latin-1")
    except UnicodeEncodeError:
        return OTHER.search(text) is None
    return not any(s in data for s in SEPARATORS)


class Memory:
    """Ids of words. When they take too much, those learnt last are forgotten: what is
    frequent was met early."""

    def __init__(self):
        self.ids: dict[str, bytes] = {}
        self.held = 0
        self.folded: tuple[str, bytes, np.ndarray] | None = None

    def fold(self) -> None:
        """Between tasks: two strings and the lengths take a tenth of the room."""
        if self.ids:
            lengths = np.fromiter(map(len, self.ids.values()), np.int32, len(self.ids))
            self.folded = " ".join(self.ids), b"".join(self.ids.values()), lengths
            self.ids = {}

    def unfold(self) -> None:
        if self.folded:
            words, data, lengths = self.folded
            ends = np.cumsum(lengths).tolist()
            self.ids = {w: data[a:b] for w, a, b in zip(words.split(" "), [0, *ends], ends)}
            self.folded = None

    def learn(self, words: list[str], ids: list[bytes]) -> None:
        self.ids.update(zip(words, ids))
        self.held += _size(words, ids)

    def shed(self, words: list[str]) -> None:
        """Forgets the long ones, and half of all if need be."""
        for w in words:
            if len(w) > LONG:
                self.held -= _size([w], [self.ids.pop(w)])
        if self.held > REMEMBERED:
            self.ids = dict(islice(self.ids.items(), len(self.ids) // 2))
            self.held = _size(self.ids, self.ids.values())


def _size(words, ids) -> int:
    return OVERHEAD * len(words) + sum(map(len, words)) + sum(map(len, ids))


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        (self.bar,) = self.tokenizer.encode(BAR, add_special_tokens=False).ids
        self.words = Memory()

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of SPLIT, in one text with a mark between them."""
        barred = [w for w in words if BAR in w]
        if barred:
            apart = dict(zip(barred, self._whole(barred)))
            free = [w for w in words if BAR not in w]
            found = dict(zip(free, self._words(free))) if free else {}
            return [apart[w] if w in apart else found[w] for w in words]
        ids = np.frombuffer(self._whole([f" {BAR} ".join(words)])[0], dtype="<u4")
        cut = 4 * np.flatnonzero(ids == self.bar)
        if len(cut) != len(words) - 1:
            return self._whole(words)
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *(cut + 4).tolist()], [*cut.tolist(), len(data)])]

    def _together(self, texts: list[str]) -> list[bytes]:
        whole = [not plain(t) for t in texts]
        split = [[] if w else SPLIT.findall(t.lower()) for t, w in zip(texts, whole)]
        new = list(set().union(*split).difference(self.words.ids))
        if new:
            self.words.learn(new, self._words(new))
        get = self.words.ids.__getitem__
        out = [
            self._whole([t])[0] if w else b"".join(map(get, s))
            for t, w, s in zip(texts, whole, split)
        ]
        self.words.shed(new)
        return out

    def each(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        self.words.unfold()
        for a, b in slices([len(t) + 1 for t in texts], TOGETHER):
            yield from self._together(texts[a:b])

    def __call__(self, text: str) -> bytes:
        return next(self.each([text]))


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)
