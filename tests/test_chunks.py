import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuscope.functions.arrays import counts, runs
from corpuscope.operators.chunks import recursive, split, windows

WORDS = st.text(alphabet="ab \n", max_size=400)


@settings(max_examples=300, deadline=None)
@given(WORDS, st.integers(8, 40))
def test_chunk_invariants(text, size):
    overlap = size // 4
    chunks = split(text, size, overlap)
    assert all(0 < len(c) <= size and c == c.strip() for c in chunks)
    at = 0
    for chunk in chunks:  # chunks are substrings in order; nothing but blanks between them
        found = text.find(chunk, max(0, at - size))
        assert found >= 0
        at = max(at, found + len(chunk))
    assert set("".join(chunks)) - set(" \n") == set(text) - set(" \n")
    assert sum(c not in " \n" for c in "".join(chunks)) >= sum(c not in " \n" for c in text)


def test_chunk_examples():
    assert split("aaa bbb ccc ddd", 7, 3) == ["aaa bbb", "ccc", "ddd"]
    # a piece keeps the blank before it, so "cc dd ee" counts nine
    assert split("aa bb cc dd ee", 8, 3) == ["aa bb cc", "cc dd", "dd ee"]
    assert split("one two three", 100, 20) == ["one two three"]
    assert split("p1 line\n\np2 line\n\np3 line", 16, 0) == ["p1 line\n\np2 line", "p3 line"]
    assert split("x" * 2500, 1000, 200) == ["x" * 1000, "x" * 1000, "x" * 900]
    assert split("", 10, 2) == [] and split(" \n ", 10, 2) == []
    words = " ".join(f"w{i:03d}" for i in range(100))
    chunks = split(words, 50, 10)
    assert all(len(c) <= 50 for c in chunks)
    assert all(a.split()[-1] in b.split() for a, b in zip(chunks, chunks[1:]))


def test_windows(spark):
    texts = ["", "a", "x" * 1000, "y" * 1001, "é😀z" * 1700, "q" * 1800, "r" * 1801]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[0] for r in rows.orderBy("i").select(windows(F.col("t"))).collect()]
    for text, chunks in zip(texts, got):
        want, at = [], 0
        while text and (at == 0 or at + 200 < len(text)):
            want.append(text[at : at + 1000])
            at += 800
        assert chunks == want
        assert chunks == split(text) or not text


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), min_size=1, max_size=10))
def test_counts_and_runs(spark, groups):
    rows = spark.createDataFrame([(i, g) for i, g in enumerate(groups)], "i int, g array<string>")
    got = rows.orderBy("i").select(
        counts(F.col("g")).alias("c"), runs(F.sort_array("g"), lambda x: x).alias("r")
    ).collect()
    for group, row in zip(groups, got):
        assert [(c.term, c.tf) for c in row.c] == [(t, group.count(t)) for t in sorted(set(group))]
        assert row.r == [[t] * group.count(t) for t in sorted(set(group))]


def random_texts(seed=3, n=120):
    rng = random.Random(seed)
    parts = ["word", " ", " ", "\n", "\n\n", "\n\n\n", "x" * 990, "y" * 1000, "z" * 2500, "é ", "\t", "  ", "　", "a b\nc"]
    texts = ["", " ", "\n\n", "\n\n\n\n", " a", "q" * 1000, "q" * 1001, "\n\n" + "r " * 700, ("s" * 999 + "\n") * 5]
    for _ in range(n):
        weights = [rng.random() for _ in parts]
        texts.append("".join(rng.choices(parts, weights, k=rng.randrange(1, 400))))
    return texts


@pytest.mark.parametrize("size,overlap", [(1000, 200), (50, 20), (7, 3), (5, 0)])
def test_columns_split_as_python_does(spark, size, overlap):
    texts = random_texts()
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(4)
    got = rows.select("id", recursive(F.col("text"), size, overlap).alias("c")).collect()
    for r in got:
        assert r.c == split(texts[r.id], size, overlap), texts[r.id][:200]
    assert len(got) == len(texts)
