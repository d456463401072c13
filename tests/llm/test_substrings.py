import collections
import hashlib

import numpy as np
import pytest

from corpuscope.llm import substrings

from . import cases


def brute(rows, window=200):
    texts = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        flag = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                flag[i : i + window] = True
        flag = flag[: len(t)]
        kept = bytes(b for b, f in zip(t, flag) if not f)
        spans = int((np.diff(np.r_[0, flag.astype(int)]) == 1).sum())
        out.append((str(d), len(t), int(flag.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def planted():
    import random

    rng = random.Random(1)
    rows = cases.corpus(n=40)
    passage = cases.words(rng, 60)
    for i in range(40):
        host = cases.words(rng, 80).split(" ")
        cut = rng.randrange(len(host))
        rows.append((3000 + i, " ".join(host[:cut]) + passage[i : len(passage) - i] + " ".join(host[cut:])))
    rows += [(4000, "ab" * 300), (4001, "ab" * 99 + "a"), (4002, "ab" * 100), (4003, "é" * 150),
             (4004, cases.words(rng, 30) + "xyz" * 100), (4005, "q" * 199), (4006, "q" * 200),
             (4007, "r" * 201)]
    long = cases.words(rng, 30000)
    return rows + [(5000, long), (5001, "y" + long[100:150000])]


@pytest.mark.parametrize("group", [2, 256])
def test_removed_bytes_match_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(substrings, "GROUP", group)
    if group == 2:
        monkeypatch.setattr(substrings, "BROADCAST_ROWS", 0)
    rows = planted()
    got = substrings.report(cases.frame(spark, rows, group == 2)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows)


def test_radix_tells_windows_apart():
    data = np.frombuffer(b"abcdefghijklmnopq" * 3 + b"abcdefghijklmnopX", np.uint8)
    at = np.arange(len(data) - 16)
    want = collections.Counter(bytes(data[i : i + 17]) for i in at)
    hit = substrings.radix(np.zeros(len(at), int), data, at, 17)
    assert list(hit) == [want[bytes(data[i : i + 17])] > 1 for i in at]


def test_empty_table(spark):
    assert substrings.report(cases.empty(spark)).count() == 0


def clashing_texts(seed=3, n=30000):
    """Two unrelated texts whose hashes agree in the upper 24 bits."""
    import random

    import xxhash

    rng, seen = random.Random(seed), {}
    for _ in range(n):
        text = cases.words(rng, 60) + ". " + cases.words(rng, 20) + "."
        high = xxhash.xxh64_intdigest(text, 42) >> 40
        if high in seen:
            return seen[high], text
        seen[high] = text
    raise AssertionError("no clash")


@pytest.mark.parametrize("id_", [None, 5])
def test_rows_of_one_id_are_told_apart_by_more_than_a_short_hash(spark, id_):
    one, other = clashing_texts()
    rows = [(id_, one), (id_, other), (7, one)]
    got = substrings.report(cases.frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows)
    from corpuscope.llm import sentences

    kept = {(r.doc_id, r.n_removed) for r in sentences.report(cases.frame(spark, rows)).collect()}
    # Of equal spans those of the smallest id stay, null first.
    assert kept == {(id_, 0), (7, 2)}


def test_equal_rows_in_bounded_groups(spark):
    """Intervals of a row that is there very often count once before they are gathered."""
    text = cases.words(__import__("random").Random(1), 300)
    docs = spark.range(100000).selectExpr("5L AS doc_id", f"'{text}' AS text")
    spans = substrings.repeated_spans(docs)
    assert [list(r.spans) for r in spans.collect()] == [[0, len(text)]]
    intervals = spark.range(100000).selectExpr(
        "1L AS mark", "2L AS twin", "int(id % 20 * 10) AS start", "int(id % 20 * 10 + 200) AS end"
    )
    merged = substrings.merged(intervals)
    assert list(merged.first().spans) == [0, 390]
    plan = merged._jdf.queryExecution().toString()
    assert "partial_collect_set" in plan
