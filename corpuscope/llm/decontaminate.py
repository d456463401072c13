"""Benchmark passages in documents: shared words, latent semantic order, exact checks.

The benchmark is read in blocks of ITEMS items or TERMS different words, each a stated
query set that meets all documents. For a block:

1. Passages of PASSAGE words of all documents are counted: in how many each word of the
   block occurs. Words in over COMMON of the passages are left out, unless they are among
   the RAREST of an item; the others weigh tf x idf.
2. Distributed randomised SVD of these passages, the block's own among them: every task
   counts which words meet in its passages, the rows of ``A'A``; added up by word they are
   projected on a random basis, ``(A'A) R``, which takes the same time for any number of
   documents. These rows (words x RANK, bounded by the block) give the leading right
   singular vectors on the driver.
3. Windows of documents, as long as the items of a length class and half overlapping, meet
   all items of the class inside the task, with no row per pair. A window and half of one on
   either side is a set of BITS bits, each standing for words of the block, and so is an
   item; a window is a candidate if it has as many of the item's bits as LOOSE of the item's
   words need at least, which loses none, however common the words. TOGETHER neighbouring
   windows meet the items as one set first. Candidates are checked
   in the order of their cosine in the latent space: the longest common subsequence of words
   with the item, and with its last words, the answer. A leak has LCS of the item's words in
   order, or at least LOOSE and the answer as well.

Cases: null text is empty and has no leaks; items without words are left out, an
item of one word is in each document with that word; repeated rows are one document and reported once; rows of one id but different texts count
together; an empty table on either side gives no leaks; columns besides id and text are
not looked at.
"""

from __future__ import annotations

import bisect
import math
import sys
import unicodedata
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import id_back, in_tasks, slices, texts

ITEMS = 256
TERMS = 8_192
RANK = 272
PASSAGE = 32
COMMON = 0.002
#: Words of an item that are kept whatever their share, its rarest.
RAREST = 8
#: The more common half of the bits stands for a word each, the others for several.
BITS = 512
LANES = BITS // 64
#: Neighbouring windows that meet the items as one set first.
TOGETHER = 4
#: Characters of the texts that are read at once.
PORTION = 1 << 20
#: Pairs of words a task holds before it counts them and gives them on.
PAIRS = 1 << 19
#: Numbers in the rows of A'A that are projected at once, or one row.
GATHERED = 1 << 20
LCS = 0.8
LOOSE = 0.6
ANSWER = 0.25
#: All punctuation of Unicode, and the ASCII marks like it.
MARKS = frozenset(
    c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c)[0] == "P" or c in "|`"
)
#: White space parts words too; Arrow splits at that of ASCII_SPACE only.
ASCII_SPACE = " \t\n\v\f\r"
PARTING = MARKS.union(filter(str.isspace, map(chr, range(sys.maxunicode + 1)))).difference(ASCII_SPACE)
ASCII_PARTING = "".join(sorted(m for m in PARTING if m.isascii()))
ASCII = bytes(range(128))


def parted(text: str) -> str:
    """The text in lower case, with words parted by ASCII_SPACE only and none around them."""
    text = text.lower()
    for mark in ASCII_PARTING:
        text = text.replace(mark, " ")
    if not text.isascii():
        for mark in PARTING.intersection(text.encode().translate(None, ASCII).decode()):
            text = text.replace(mark, " ")
    return text.strip(ASCII_SPACE)


def words_of(text: str) -> list[str]:
    """Lower-case words; the marks in MARKS part them like white space."""
    return parted(text).split()


class Reader:
    """Numbers of a block's words in texts: one per word, -1 for other words."""

    def __init__(self, vocabulary: dict[str, int]):
        self.words = pa.array(list(vocabulary), pa.large_string())

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all texts, one after the other, and how many each text has."""
        words = pc.ascii_split_whitespace(pa.array([parted(t) or None for t in texts], pa.large_string()))
        numbers = pc.index_in(words.flatten(), value_set=self.words).fill_null(-1)
        sizes = pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False)
        return numbers.to_numpy(zero_copy_only=False), sizes.astype(np.int64)


def portions(column: pa.Array):
    """Texts of a column, as many as PORTION bytes or one."""
    for a, b in slices(pc.binary_length(column).to_pylist(), PORTION):
        yield column.slice(a, b - a).to_pylist()


def passages(numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers of the block's words, the passage of each, and the passages of all texts."""
    each = -(-sizes // PASSAGE)
    at = np.flatnonzero(numbers >= 0)
    text = np.repeat(np.arange(len(sizes)), sizes)[at]
    place = at - (np.cumsum(sizes) - sizes)[text]
    return numbers[at], (np.cumsum(each) - each)[text] + place // PASSAGE, int(each.sum())


def length_class(n: int) -> int:
    """Words of the windows an item of n words is compared with."""
    return max(8, 1 << (n - 1).bit_length())


class Block:
    """A block of items: words, vocabulary, and later the latent space."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.items = items
        self.vocabulary: dict[str, int] = {}
        for _, words in items:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary))
        self.numbers = [np.array([self.vocabulary[w] for w in words]) for _, words in items]

    def weigh(self, passages: int, containing: np.ndarray) -> None:
        share = containing / max(1, passages)
        kept = share <= COMMON
        for numbers in self.numbers:
            own = np.unique(numbers)
            kept[own[np.argsort(share[own], kind="stable")[:RAREST]]] = True
        self.idf = np.where(kept, np.log((1 + passages) / (1 + containing)) + 1, 0.0)
        rank = np.empty(len(share), dtype=np.int64)
        rank[np.argsort(-share, kind="stable")] = np.arange(len(share))
        self.bit = np.where(rank < BITS // 2, rank, BITS // 2 + rank % (BITS // 2))
        self.basis = np.random.default_rng(5).standard_normal((len(self.vocabulary), RANK))

    def span(self, summed: np.ndarray) -> None:
        """Latent vectors from G R, where G = A'A: single-pass (Nystroem) eigenvectors."""
        for numbers in self.numbers:
            row = self.idf[numbers]
            np.add.at(summed, numbers, row[:, None] * (row @ self.basis[numbers]))
        core = self.basis.T @ summed
        values, vectors = np.linalg.eigh((core + core.T) / 2)
        keep = values > values.max() * 1e-9 if len(values) and values.max() > 0 else values > 0
        half = summed @ (vectors[:, keep] / np.sqrt(values[keep]))
        left, _, _ = np.linalg.svd(half, full_matrices=False)
        self.basis = None
        self.latent = (self.idf[:, None] * left).astype(np.float32)
        lane = np.arange(LANES) == (self.bit // 64)[:, None]
        self.masks = np.where(lane, np.uint64(1) << (self.bit % 64).astype(np.uint64)[:, None], np.uint64(0))
        self.unit = np.zeros((len(self.numbers), self.latent.shape[1]), dtype=np.float32)
        self.classes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        groups = defaultdict(list)
        for k, numbers in enumerate(self.numbers):
            groups[length_class(len(numbers))].append(k)
        for width, members in groups.items():
            rows = np.stack([self.latent[self.numbers[k]].sum(0) for k in members])
            size = np.linalg.norm(rows, axis=1, keepdims=True)
            unit = np.where(size > 0, rows / np.where(size > 0, size, 1), 0)
            self.unit[members] = unit
            bits = np.stack([np.bitwise_or.reduce(self.masks[self.numbers[k]]) for k in members])
            least = np.array([self.least_bits(self.numbers[k]) for k in members], dtype=np.uint16)
            self.classes[width] = (np.array(members), bits, least)

    def least_bits(self, numbers: np.ndarray) -> int:
        """Bits that LOOSE of an item's words have at least."""
        words = np.sort(np.bincount(self.bit[numbers]))[::-1]
        return 1 + int(np.searchsorted(np.cumsum(words), LOOSE * len(numbers)))


def blocks(benchmark: DataFrame):
    """The benchmark, a block at a time; the driver holds one block."""
    held, terms = [], set()
    for r in texts(benchmark, "item_id").orderBy("doc", "text").toLocalIterator():
        words = words_of(r.text)
        if not words:
            continue
        if held and (len(held) == ITEMS or len(terms.union(words)) > TERMS):
            yield Block(held)
            held, terms = [], set()
        held.append((r.doc, words))
        terms.update(words)
    if held:
        yield Block(held)


def count(docs: DataFrame, vocabulary: dict[str, int]) -> tuple[int, np.ndarray]:
    """Passages of all documents, and how many contain each word."""

    def run(batches):
        read, total = Reader(vocabulary), 0
        found = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for some in portions(batch.column(1)):
                term, passage, n = passages(*read(some))
                total += n
                pairs = np.sort(passage * len(vocabulary) + term)
                first = np.r_[True, pairs[1:] != pairs[:-1]][: len(pairs)]
                found += np.bincount(pairs[first] % len(vocabulary), minlength=len(vocabulary))
        met = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, met]), pa.array(np.r_[total, found[met]])], names=["term", "n"]
        )

    rows = in_tasks(texts(docs), run, "term long, n long").groupBy("term").agg(F.sum("n"))
    found = np.zeros(len(vocabulary) + 1, dtype=np.int64)
    for term, n in rows.collect():
        found[term] = n
    return int(found[-1]), found[:-1]


def meeting(term: np.ndarray, passage: np.ndarray, terms: int) -> np.ndarray:
    """All pairs of words of a passage, in both orders and each with itself, as word * terms + word."""
    starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    size = np.diff(np.r_[starts, len(term)])
    each = np.repeat(size, size)
    among = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    return np.repeat(term.astype(np.int64) * terms, each) + term[np.repeat(np.repeat(starts, size), each) + among]


def project(docs: DataFrame, block: Block) -> np.ndarray:
    """A' (A R) over the passages of all documents."""
    shared = docs.sparkSession.sparkContext.broadcast((block.vocabulary, block.idf, block.basis))
    terms, width = block.basis.shape
    kind = np.min_scalar_type(terms)

    def rows_of(pairs: np.ndarray):
        """(word, the words it meets, how often each)"""
        keys, n = np.unique(pairs, return_counts=True)
        term, others, n = keys // terms, (keys % terms).astype(kind), n.astype(np.int32)
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]][: len(term)])
        for at in range(0, len(first), 1000):
            some = first[at : at + 1000]
            ends = np.r_[first, len(term)][at + 1 : at + 1001]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(term[some]),
                    pa.array([others[a:b].tobytes() for a, b in zip(some, ends)], pa.binary()),
                    pa.array([n[a:b].tobytes() for a, b in zip(some, ends)], pa.binary()),
                ],
                names=["term", "others", "n"],
            )

    def run(batches):
        vocabulary, idf, _ = shared.value
        read, pairs, size = Reader(vocabulary), [], 0
        for batch in batches:
            held, passage, first = [], [], 0
            for some in portions(batch.column(1)):
                term, group, more = passages(*read(some))
                kept = idf[term] > 0
                held.append(term[kept])
                passage.append(first + group[kept])
                first += more
            if not held:
                continue
            term, group = np.concatenate(held), np.concatenate(passage)
            for a in range(0, len(term), 20_000):
                # A passage cut here counts as two.
                pairs.append(meeting(term[a : a + 20_000], group[a : a + 20_000], terms))
                size += len(pairs[-1])
                if size > PAIRS:
                    yield from rows_of(np.concatenate(pairs))
                    pairs, size = [], 0
        if pairs:
            yield from rows_of(np.concatenate(pairs))

    def total(batches):
        _, idf, basis = shared.value
        weighted = idf[:, None] * basis
        sums, met = np.zeros((max(1, GATHERED // terms), terms)), []

        def projected():
            rows = idf[met][:, None] * (sums[: len(met)] @ weighted)
            return pa.RecordBatch.from_arrays(
                [pa.array(met, pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary())],
                names=["term", "row"],
            )

        for batch in batches:
            for term, others, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if not met or met[-1] != term:
                    if len(met) == len(sums):
                        yield projected()
                        sums[:], met = 0, []
                    met.append(term)
                sums[len(met) - 1, np.frombuffer(others, kind)] += np.frombuffer(n, np.int32)
        if met:
            yield projected()

    summed = np.zeros((terms, width))
    partial = in_tasks(texts(docs), run, "term long, others binary, n binary")
    by_term = partial.repartition("term").sortWithinPartitions("term")
    for r in in_tasks(by_term, total, "term long, row binary").toLocalIterator():
        summed[r.term] = np.frombuffer(r.row, np.float64)
    shared.destroy()
    return summed


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence."""
    places = defaultdict(list)
    for k, x in enumerate(b):
        places[x].append(k)
    ends: list[int] = []
    for x in a:
        for k in reversed(places.get(x, ())):
            at = bisect.bisect_left(ends, k)
            if at == len(ends):
                ends.append(k)
            else:
                ends[at] = k
    return len(ends)


def neighbours(half: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The sets of each half window, the one before it and the two after it, as one."""
    around, gap, two = own.copy(), np.diff(half), half[2:] - half[:-2]
    around[1:] |= own[:-1] * (gap == 1)[:, None]
    around[:-1] |= own[1:] * (gap <= 2)[:, None]
    around[:-2] |= own[2:] * (two == 2)[:, None]
    return around


def enough(rows: np.ndarray, bits: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, item) of all rows that have as many of an item's bits as it needs, by row."""
    kind = np.uint8 if int(np.bitwise_count(bits).sum(axis=1, dtype=np.int64).max()) < 256 else np.uint16
    least = least.astype(kind)

    def meet(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shared = np.zeros((len(sets), len(bits)), dtype=kind)
        for k in range(LANES):
            shared += np.bitwise_count(sets[:, k, None] & bits[:, k])
        return np.nonzero(shared >= least)

    found = [(np.zeros(0, np.int64),) * 2]
    groups = np.bitwise_or.reduceat(rows, np.arange(0, len(rows), TOGETHER), axis=0)
    full = np.flatnonzero(np.bitwise_count(groups).sum(axis=1, dtype=np.uint16) >= least.min())
    for a in range(0, len(full), 256):
        group, item = meet(groups[full[a : a + 256]])
        row = (full[a + group, None] * TOGETHER + np.arange(TOGETHER)).ravel()
        item = np.repeat(item, TOGETHER)
        row, item = row[row < len(rows)], item[row < len(rows)]
        shared = np.bitwise_count(rows[row] & bits[item]).sum(axis=1, dtype=kind)
        found.append((row[shared >= least[item]], item[shared >= least[item]]))
    row, item = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((item, row))
    return row[order], item[order]


class Finder:
    """Leaks of a block's items in texts, many texts at a time."""

    def __init__(self, block: Block):
        self.block, self.read = block, Reader(block.vocabulary)
        self.widest = max(block.classes, default=8)
        self.own = [numbers.tolist() for numbers in block.numbers]
        self.distinct = [set(numbers) for numbers in self.own]

    def candidates(self, numbers: np.ndarray, sizes: np.ndarray):
        """(text, item, start, width, cosine) of windows with enough of an item's words."""
        block = self.block
        # Texts lie on one line, so far apart that no window meets two of them.
        room = -(-sizes // self.widest) * self.widest + 2 * self.widest
        base = np.cumsum(np.r_[self.widest, room])[:-1]
        at = np.flatnonzero(numbers >= 0)
        term = numbers[at]
        place = at + np.repeat(base - np.cumsum(sizes) + sizes, sizes)[at]
        if not len(term):
            return
        found = []
        half, own, last = place, None, 1
        for width in sorted(block.classes):
            members, bits, least = block.classes[width]
            step = width // 2
            # Half windows are made of those of the class before, the first ones of words.
            half = half // (step // last)
            cut = np.flatnonzero(np.r_[True, half[1:] != half[:-1]])
            half, last = half[cut], step
            if own is None:
                own = np.empty((len(cut), LANES), dtype=np.uint64)
                edges = np.searchsorted(cut, np.arange(16_384, len(term), 16_384))
                edges = np.unique(np.r_[0, edges, len(cut)])
                ends = np.r_[cut, len(term)]
                for a, b in zip(edges[:-1], edges[1:]):
                    some = block.masks[term[ends[a] : ends[b]]]
                    own[a:b] = np.bitwise_or.reduceat(some, cut[a:b] - ends[a])
            else:
                own = np.bitwise_or.reduceat(own, cut)
            # The first word of a leak is in the first half of a window.
            windows, items = enough(neighbours(half, own), bits, least)
            cuts = np.flatnonzero(np.r_[True, windows[1:] != windows[:-1]][: len(windows)])
            for a, b in zip(cuts, np.r_[cuts[1:], len(windows)]):
                start = int(half[windows[a]]) * step
                i, j = np.searchsorted(place, [start, start + width])
                row = block.latent[term[i:j]].sum(0)
                norm = float(np.linalg.norm(row)) or 1.0
                for k in members[items[a:b]]:
                    found.append((float(row @ block.unit[k]) / norm, int(k), start, width))
        found.sort(key=lambda f: (-f[0], f[1], f[2]))
        for cosine, item, start, width in found:
            text = int(np.searchsorted(base, start + width - 1, side="right")) - 1
            yield text, item, start - int(base[text]), width, cosine

    def __call__(self, texts: list[str]) -> list[list[tuple]]:
        """Per text: (item id, start, cosine, lcs, answer), by an item's best window."""
        out: list[list[tuple]] = [[] for _ in texts]
        for a, b in slices(list(map(len, texts)), PORTION):
            numbers, sizes = self.read(texts[a:b])
            ends = np.cumsum(sizes)
            done = set()
            for k, item, start, width, cosine in self.candidates(numbers, sizes):
                if (k, item) in done:
                    continue
                words = numbers[ends[k] - sizes[k] : ends[k]]
                part = words[max(0, start - width // 2) : start + width + width // 2]
                leak = self.checked(part.tolist(), item)
                if leak:
                    done.add((k, item))
                    name = self.block.items[item][0]
                    out[a + k].append((name, max(0, start), cosine, *leak))
        return out

    def checked(self, part: list[int], item: int):
        """Shares of the item and of its answer that the words around a window have in order."""
        own = self.own[item]
        # No subsequence is longer than the words that occur at all.
        shared = self.distinct[item].intersection(part)
        if sum(w in shared for w in own) < LOOSE * len(own):
            return None
        lcs = common_subsequence(own, part) / len(own)
        if lcs < LOOSE:
            return None
        tail = own[-max(1, math.ceil(len(own) * ANSWER)) :]
        answer = common_subsequence(tail, part) / len(tail)
        return (lcs, answer) if lcs >= LCS or answer >= LCS else None


def prepared(docs: DataFrame, benchmark: DataFrame):
    for block in blocks(benchmark):
        block.weigh(*count(docs, block.vocabulary))
        block.span(project(docs, block))
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc, item, start, cosine, lcs, answer): one row per document and item it has."""
    schema = "doc long, item long, start long, cosine double, lcs double, answer double"
    spark = docs.sparkSession
    found = spark.createDataFrame([], schema)
    for block in prepared(docs, benchmark):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            find = Finder(shared.value)
            for batch in batches:
                ids, found = batch.column(0).to_pylist(), find(batch.column(1).to_pylist())
                rows = [(doc, *leak) for doc, leaks in zip(ids, found) for leak in leaks]
                if rows:
                    kinds = (*(pa.int64(),) * 3, *(pa.float64(),) * 3)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                        names=["doc", "item", "start", "cosine", "lcs", "answer"],
                    )

        found = found.union(in_tasks(texts(docs), run, schema))
    best = F.max(F.struct("lcs", "answer", "cosine", (-F.col("start")).alias("start")))
    return found.groupBy("doc", "item").agg(best.alias("b")).select(
        "doc", "item", (-F.col("b.start")).alias("start"), "b.cosine", "b.lcs", "b.answer"
    )


def reject(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without a leak."""
    left, place = docs, docs.columns.index("text")
    for block in prepared(docs, benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            find = Finder(shared.value)
            for batch in batches:
                found = find([t or "" for t in batch.column(place).to_pylist()])
                clean = [not leaks for leaks in found]
                yield batch.filter(pa.array(clean, pa.bool_()))

        left = in_tasks(left, run, docs.schema)
    return left


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark).select(
        id_back(),
        id_back("item", "item_id"),
        F.col("start").alias("start_word"),
        F.round("cosine", 4).alias("cosine"),
        F.round("lcs", 4).alias("lcs"),
        F.round("answer", 4).alias("answer"),
    )
