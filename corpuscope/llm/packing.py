"""Documents packed into sequences of LENGTH tokens by sum-of-squares placement.

Each task fills its own sequences. An array counts the open sequences at each fill level;
a piece goes where the sum of the squares of these counts gets smallest, be it an open
sequence with room or a new one, so that no level piles up. Documents longer than a
sequence fill whole ones with their front. Once OPEN sequences are open, the next piece is
cut to close the fullest of them, which bounds what a task holds. At the end of its input
a task takes the emptiest of its open sequences apart, their pieces are cut to fill the
others, and what is left over becomes sequences whose lengths are powers of two. So nothing
is padded, and the other sequences stay as they were placed.

A sequence's number is its task's number and a count, so numbers are unique without an
exchange; a task that runs again gives the same numbers.

Cases: null text is empty; an empty text is its end token alone; repeated rows and rows
without an id are packed each; a text is tokenised whole in one task, however long; of
equally good levels the fullest is taken; an empty table gives no rows; columns besides id
and text are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import id_back, in_tasks, texts
from corpuscope.llm.tokens import encoder

LENGTH = 4096
END = 2
OPEN = 256


class Packer:
    """Open sequences of one task. A piece is (document, start, ids, ids of the document)."""

    def __init__(self, length: int = LENGTH, most_open: int = OPEN):
        self.length, self.most_open = length, most_open
        self.level = np.zeros(length + 1, dtype=np.int64)
        self.at: dict[int, list[list]] = {}
        self.open = 0
        #: Tokens moved after their placement.
        self.poured = 0

    def _take(self, level: int) -> list:
        self.level[level] -= 1
        self.open -= 1
        return self.at[level].pop()

    def _put(self, sequence: list, level: int):
        if level == self.length:
            yield sequence
            return
        self.level[level] += 1
        self.open += 1
        self.at.setdefault(level, []).append(sequence)

    def _best(self, size: int) -> int:
        """Level to place a piece at; 0 opens a sequence."""
        levels = np.flatnonzero(self.level[: self.length - size + 1])
        after = levels + size
        full = after == self.length
        gain = np.where(full, 0, 2 * self.level[np.where(full, 0, after)] + 1)
        gain -= 2 * self.level[levels] - 1
        new = 2 * self.level[size] + 1 if size < self.length else 0
        if len(levels):
            best = len(gain) - 1 - int(np.argmin(gain[::-1]))
            if gain[best] <= new:
                return int(levels[best])
        return 0

    def add(self, document, ids: bytes):
        """Yields the sequences that get full."""
        total, start = len(ids) // 4, 0

        def piece(n: int):
            return (document, start, ids[4 * start : 4 * (start + n)], total)

        while total - start >= self.length:
            yield [piece(self.length)]
            start += self.length
        if start < total and self.open >= self.most_open:
            fullest = int(np.flatnonzero(self.level)[-1])
            n = min(self.length - fullest, total - start)
            sequence = self._take(fullest)
            sequence.append(piece(n))
            yield from self._put(sequence, fullest + n)
            start += n
        if start < total:
            size = total - start
            level = self._best(size)
            sequence = self._take(level) if level else []
            sequence.append(piece(size))
            yield from self._put(sequence, level + size)

    def finish(self):
        """Yields the rest: full sequences, then lengths that are powers of two.

        The fuller sequences stay as they were placed; only the emptiest are taken apart, and
        their pieces, cut where needed, fill the room left in the others.
        """
        rest = [s for level in sorted(self.at) for s in self.at[level]]
        size = [sum(len(p[2]) // 4 for p in s) for s in rest]
        self.at, self.open = {}, 0
        self.level[:] = 0
        loose: list[tuple] = []
        emptiest, fullest = 0, len(rest) - 1
        while emptiest <= fullest:
            sequence, room = rest[fullest], self.length - size[fullest]
            fullest -= 1
            while room and (loose or emptiest <= fullest):
                if not loose:
                    loose = rest[emptiest][::-1]
                    emptiest += 1
                room = self._pour(loose, sequence, room)
            if room:
                loose = sequence[::-1]
                break
            yield sequence
        left = sum(len(p[2]) // 4 for p in loose)
        while left:
            room = min(self.length, 1 << left.bit_length() - 1)
            left -= room
            sequence: list[tuple] = []
            while room:
                room = self._pour(loose, sequence, room)
            yield sequence

    def _pour(self, loose: list[tuple], sequence: list[tuple], room: int) -> int:
        """Moves the last loose piece, or what fits of it; the room left after it."""
        document, start, ids, total = loose.pop()
        n = min(room, len(ids) // 4)
        sequence.append((document, start, ids[: 4 * n], total))
        if 4 * n < len(ids):
            loose.append((document, start + n, ids[4 * n :], total))
        self.poured += n
        return room - n


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """Per piece: doc, start, length, ids (little-endian unsigned 32 bit), doc_tokens,
    sequence_id, offset. ``tokenizer`` is the path of a tokenizer file on every executor."""

    def run(batches):
        encode = encoder(tokenizer)
        last = np.array([end], dtype="<u4").tobytes()
        packer = Packer(length)
        number = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []

        def written():
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        def note(sequence):
            nonlocal number
            offset = 0
            for document, start, ids, total in sequence:
                n = len(ids) // 4
                rows.append((document, start, n, ids, total, number, offset))
                offset += n
            number += 1

        for batch in batches:
            ids = encode.each(batch.column(1).to_pylist())
            for document, found in zip(batch.column(0).to_pylist(), ids):
                for sequence in packer.add(document, found + last):
                    note(sequence)
                if len(rows) > 2000:
                    yield written()
                    rows = []
        encode.words.fold()
        for sequence in packer.finish():
            note(sequence)
        if rows:
            yield written()

    return in_tasks(
        texts(docs),
        run,
        "doc long, start long, length long, ids binary, doc_tokens long, sequence_id long,"
        " offset long",
    )


def report(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    return pack(docs, tokenizer, length).select(
        id_back(),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
