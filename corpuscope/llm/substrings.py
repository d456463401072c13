"""Repeated strings of WINDOW bytes: a radix sort of suffixes, cut off at that depth.

A suffix of a text is told apart only through its first WINDOW bytes, its window; groups
of suffixes that are equal so far are split by the next digit, a suffix alone in its
group leaves, and groups that reach the full depth are the repeated windows.

1. First digit: the gram at the window's anchor (``windows.py``), which equal windows
   have at the same place. Suffixes that follow each other and share an anchor are one
   row, about 1 for 60 bytes. Rows whose gram is nowhere else leave.
2. Second digit: the whole run of windows of a row. Where it occurs twice, all of its
   windows are repeated. Of each different run one row goes on, and only if its gram has
   several runs.
3. Further digits, eight bytes each: within the runs of one gram, on the bytes
   themselves, in a task that reads sorted rows and holds one group at a time. A gram
   with more than GROUP different runs is taken apart further by Spark: its windows are
   the next digit, counted with partial aggregation.

Each list of what occurs several times is stored before it meets the rows again, so the
rows of a hot gram can be split. The table of texts is exchanged only if the ranges it has to meet are more than
BROADCAST_ROWS; below that they are broadcast.

Cases: null text is empty and, like texts under WINDOW bytes, has nothing removed;
repeated rows are all removed, as each repeats the other; rows are told apart by 128 bits
of hash over id and text, so ids may repeat or be null; texts of any length are read in blocks; a
tie, which of equal strings counts as repeated, does not arise, as all do; an empty table
gives no rows; columns besides id and text are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import id_back, in_tasks, marked, slices, stored
from corpuscope.llm.windows import CHUNK, GRAM, Strings, anchors

WINDOW = 200
#: Different runs of one gram that a task may hold: about 5 MB of bytes, a million windows.
GROUP = 16_384
BROADCAST_ROWS = 1_000_000
PLACE = {"mark": "int64", "twin": "int64", "start": "int32"}
RUNS = "gram long, run long, mark long, twin long, span int, start int"


def batch_of(rows: list[tuple], kinds: dict[str, str]) -> pa.RecordBatch:
    columns = [
        pa.array(c, pa.type_for_alias(k)) for c, k in zip(zip(*rows), kinds.values())
    ]
    return pa.RecordBatch.from_arrays(columns, names=list(kinds))


def runs_of(pieces: list[bytes], window: int):
    """Of pieces that are hashed together: (piece, start in it, last - start, gram, run)."""
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    strings = Strings(data)
    grams = strings.grams()
    place = anchors(grams, window - GRAM + 1)
    ends = np.cumsum([len(p) for p in pieces])
    whole = np.ones(len(place), dtype=bool)
    begin = 0
    for end in ends:
        whole[max(begin, end - window + 1) : end] = False
        begin = end
    at = np.flatnonzero(whole)
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(place[at]) != 0)) + 1
    first, last = at[np.r_[0, cut]], at[np.r_[cut - 1, len(at) - 1]]
    piece = np.searchsorted(ends, first, side="right")
    start = first - np.r_[0, ends][piece]
    run = strings.hashes(first, last - first + window)
    return piece, start, last - first, grams[place[first]], run


def scan(docs: DataFrame, window: int) -> DataFrame:
    """RUNS of all texts; span is the number of a run's windows - 1."""

    def run(batches):
        for batch in batches:
            marks, twins = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            pieces = [
                (row, base, text[base : base + CHUNK + window - 1])
                for row, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist())
                for base in range(0, len(text) - window + 1, CHUNK)
            ]
            for a, b in slices([len(p[2]) for p in pieces], CHUNK + window):
                row = np.array([p[0] for p in pieces[a:b]])
                base = np.array([p[1] for p in pieces[a:b]])
                piece, start, span, gram, whole = runs_of([p[2] for p in pieces[a:b]], window)
                row = row[piece]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram.view(np.int64)),
                        pa.array(whole.view(np.int64)),
                        pa.array(marks[row]),
                        pa.array(twins[row]),
                        pa.array(span.astype(np.int32)),
                        pa.array((start + base[piece]).astype(np.int32)),
                    ],
                    names=["gram", "run", "mark", "twin", "span", "start"],
                )

    return in_tasks(marked(docs).select("mark", "twin", "text"), run, RUNS)


def beside(docs: DataFrame, lists: DataFrame, rows: int, how: str) -> DataFrame:
    """Texts joined with one row of lists per text; the lists have ``rows`` entries."""
    lists = F.broadcast(lists) if rows <= BROADCAST_ROWS else lists
    return marked(docs).join(lists, ["mark", "twin"], how)


def with_bytes(docs: DataFrame, wanted: DataFrame, rows: int, window: int) -> DataFrame:
    """(gram, several, own, mark, twin, start, data) for the runs in ``wanted``."""
    entry = F.struct("gram", "several", "own", "start", "span")
    lists = wanted.groupBy("mark", "twin").agg(F.collect_list(entry).alias("runs"))
    joined = beside(docs, lists, rows, "inner")
    kinds = {"gram": "int64", "several": "int64", "own": "bool", **PLACE, "data": "binary"}

    def run(batches):
        for batch in batches:
            out = []
            marks, twins, data, runs = (batch.column(i) for i in range(4))
            data = data.cast(pa.binary()).to_pylist()
            for mark, twin, text, entries in zip(marks.to_pylist(), twins.to_pylist(), data, runs):
                for x in entries.as_py():
                    part = text[x["start"] : x["start"] + x["span"] + window]
                    out.append((x["gram"], x["several"], x["own"], mark, twin, x["start"], part))
            if out:
                yield batch_of(out, kinds)

    return joined.select("mark", "twin", "text", "runs").mapInArrow(
        run,
        "gram long, several long, own boolean, mark long, twin long, start int, data binary",
    )


def radix(group: np.ndarray, data: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Which of the suffixes ``at`` agree with another of their group through ``window`` bytes."""
    alive = np.arange(len(at))
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    depth = 0
    while len(alive) and depth < window:
        # The last digit may overlap the one before.
        here = at[alive] + min(depth, window - 8)
        digit = words[here].copy().view(np.uint64).ravel()
        order = np.lexsort((digit, group))
        g, d = group[order], digit[order]
        new = np.r_[True, (g[1:] != g[:-1]) | (d[1:] != d[:-1])]
        number = np.cumsum(new) - 1
        keep = np.bincount(number)[number] > 1
        alive, group = alive[order[keep]], number[keep]
        depth += 8
    repeated = np.zeros(len(at), dtype=bool)
    repeated[alive] = True
    return repeated


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true."""
    edge = np.diff(np.r_[0, flags.view(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def sort_groups(rows: DataFrame, window: int) -> DataFrame:
    """(mark, twin, start, end) covered by windows repeated within their gram's runs."""

    kinds = {**PLACE, "end": "int32"}

    def settle(parts):
        grams, own, marks, twins, starts, data = (sum(c, []) for c in zip(*parts))
        if not data:
            return []
        size = np.array([len(d) for d in data])
        base = np.cumsum(size) - size
        n = size - window + 1
        row = np.repeat(np.arange(len(data)), n)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        _, group = np.unique(np.array(grams), return_inverse=True)
        buffer = np.frombuffer(b"".join(data), dtype=np.uint8)
        hit = radix(group[row], buffer, base[row] + inside, window)
        found = []
        first = np.cumsum(n) - n
        for k in range(len(data)):
            if own[k]:
                a, b = stretches(hit[first[k] : first[k] + n[k]])
                found += [
                    (marks[k], twins[k], starts[k] + int(x), starts[k] + int(y) - 1 + window)
                    for x, y in zip(a, b)
                ]
        return found

    def run(batches):
        # Rows of the last gram seen wait, as more of them may follow.
        held = []
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = [c.to_pylist() for c in batch.slice(at, 512).columns]
                cut = part[0].index(part[0][-1])
                if held and not cut and part[0][0] == held[-1][0][-1]:
                    held.append(part)
                    continue
                found = settle([*held, [c[:cut] for c in part]])
                if found:
                    yield batch_of(found, kinds)
                held = [[c[cut:] for c in part]]
        found = settle(held) if held else []
        if found:
            yield batch_of(found, kinds)

    return (
        rows.select("gram", "own", "mark", "twin", "start", "data")
        .repartition("gram")
        .sortWithinPartitions("gram")
        .mapInArrow(run, "mark long, twin long, start int, end int")
    )


def count_windows(rows: DataFrame, window: int) -> DataFrame:
    """The same for grams with very many different runs: every window is a row."""

    def run(batches):
        for batch in batches:
            gram, own, mark, twin, start = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:5])
            data = batch.column(5).to_pylist()
            for a, b in slices([len(d) for d in data], CHUNK):
                size = np.array([len(d) for d in data[a:b]])
                base = np.cumsum(size) - size
                n = size - window + 1
                row = np.repeat(np.arange(a, b), n)
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                strings = Strings(np.frombuffer(b"".join(data[a:b]), dtype=np.uint8))
                whole = strings.hashes(np.repeat(base, n) + inside, window)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram[row]),
                        pa.array(whole.view(np.int64)),
                        pa.array(own[row]),
                        pa.array(mark[row]),
                        pa.array(twin[row]),
                        pa.array((start[row] + inside).astype(np.int32)),
                    ],
                    names=["gram", "window", "own", "mark", "twin", "start"],
                )

    expanded = rows.select("gram", "own", "mark", "twin", "start", "data").mapInArrow(
        run, "gram long, window long, own boolean, mark long, twin long, start int"
    )
    twice = stored(
        expanded.groupBy("gram", "window").count().where("count > 1").drop("count"),
        "substring-windows",
    )
    return expanded.where("own").join(twice, ["gram", "window"]).select(
        "mark", "twin", "start", (F.col("start") + window).alias("end")
    )


def merged(intervals: DataFrame) -> DataFrame:
    """(mark, twin, spans): the union of a text's intervals, as arrays of start and end.

    Repeated rows have the same intervals, which count once before they are exchanged.
    """
    lists = intervals.groupBy("mark", "twin").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")
    )

    def run(batches):
        for batch in batches:
            spans = batch.column(2)
            flat = spans.flatten()
            start, end = (flat.field(k).to_numpy() for k in (0, 1))
            first = spans.offsets.to_numpy()
            out = []
            for k in range(batch.num_rows):
                s, e = start[first[k] : first[k + 1]], end[first[k] : first[k + 1]]
                reach = np.maximum.accumulate(e)
                new = np.r_[True, s[1:] > reach[:-1]]
                at = np.flatnonzero(new)
                out.append(np.stack([s[at], reach[np.r_[at[1:] - 1, len(s) - 1]]], 1).ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))],
                names=["mark", "twin", "spans"],
            )

    return lists.mapInArrow(run, "mark long, twin long, spans array<int>")


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(mark, twin, spans): bytes covered by windows that start somewhere else as well."""
    if not 136 <= window <= 319:
        raise ValueError("window out of range")
    runs = scan(docs, window)
    shared = stored(
        runs.groupBy("gram").count().where("count > 1").select("gram"), "substring-grams"
    )
    left = stored(runs.join(shared, "gram"), "substring-runs")
    different = left.groupBy("gram", "run").agg(
        F.count("*").alias("n"), F.min(F.struct("mark", "twin", "span", "start")).alias("one")
    )
    different = stored(different, "substring-different")
    several = stored(
        different.groupBy("gram").agg(F.count("*").alias("several")).where("several > 1"),
        "substring-several",
    )
    wanted = stored(
        different.join(several, "gram").select(
            "gram", "several", (F.col("n") == 1).alias("own"), "one.*"
        ),
        "substring-wanted",
    )
    data = stored(with_bytes(docs, wanted, wanted.count(), window), "substring-bytes")
    whole = left.join(different.where("n > 1").select("gram", "run"), ["gram", "run"])
    intervals = (
        whole.select("mark", "twin", "start", (F.col("start") + F.col("span") + window).alias("end"))
        .union(sort_groups(data.where(F.col("several") <= GROUP), window))
        .union(count_windows(data.where(F.col("several") > GROUP), window))
    )
    return stored(merged(intervals), "substring-spans")


def remove(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc, n_bytes, spans (removed, start and end in turn), kept (bytes left)."""
    spans = repeated_spans(docs, window)
    rows = spans.agg(F.sum(F.size("spans"))).first()[0] or 0
    joined = beside(docs, spans, rows, "left").select("doc", "text", "spans")

    def run(batches):
        for batch in batches:
            data = batch.column(1).cast(pa.binary()).to_pylist()
            for a, b in slices([len(d) for d in data], 1 << 23):
                kept = []
                for text, cut in zip(data[a:b], batch.column(2).slice(a, b - a).to_pylist()):
                    edges = [0, *(cut or []), len(text)]
                    kept.append(b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(d) for d in data[a:b]], pa.int64()),
                        batch.column(2).slice(a, b - a),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["doc", "n_bytes", "spans", "kept"],
                )

    return joined.mapInArrow(run, "doc long, n_bytes long, spans array<int>, kept binary")


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    rows = remove(docs, window)
    return rows.select(
        id_back(),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.coalesce(F.size("spans") / 2, F.lit(0)).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
