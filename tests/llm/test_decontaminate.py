import random
import time
from itertools import repeat

import numpy as np

from corpuscope.llm import decontaminate

from . import cases


def planted(n=150):
    rng = random.Random(11)
    items = [(k, cases.words(rng, rng.randrange(10, 70), 3000)) for k in range(40)]
    rows, leaks = cases.corpus(n=40), set()
    for i in range(n):
        host = cases.words(rng, rng.randrange(30, 400), 3000).split()
        if i % 3 == 0:
            k = rng.randrange(40)
            words = items[k][1].split()
            if i % 2:
                # A paraphrase: some words changed, case and marks too.
                for _ in range(len(words) // 8):
                    words[rng.randrange(len(words))] = "other"
                words[0] = words[0].upper() + ","
            cut = rng.randrange(len(host))
            host[cut:cut] = words
            leaks.add((8000 + i, k))
        rows.append((8000 + i, " ".join(host)))
    return rows, items, leaks


def test_planted_leaks_are_found_and_others_stay(spark, monkeypatch):
    rows, items, want = planted()
    monkeypatch.setattr(decontaminate, "ITEMS", 25)
    docs = cases.frame(spark, rows, True).repartition(4)
    bench = spark.createDataFrame(
        [*items, (90, None), (91, " .. "), (None, "no id here " * 5)], "item_id long, text string"
    )
    got = {(r.doc_id, r.item_id) for r in decontaminate.report(docs, bench).collect()}
    assert got <= want
    assert len(got) >= 0.95 * len(want)
    left = decontaminate.reject(docs, bench)
    assert left.columns == docs.columns
    assert left.count() == len(rows) - len({d for d, _ in got})


def test_paraphrases_without_the_rare_words(spark):
    rng, items, rows = random.Random(23), [], []
    for k in range(30):
        common = cases.words(rng, 15, 300).split()
        rare = ["rare%dx%d" % (k, i) for i in range(9)]
        items.append((k, " ".join(rare + common)))
        host = cases.words(rng, rng.randrange(100, 300), 300).split()
        cut = rng.randrange(len(host))
        host[cut:cut] = ["other%d" % rng.randrange(10**6) for _ in rare] + common
        rows.append((k, " ".join(host)))
    rows += [(100 + k, cases.words(rng, 300, 300)) for k in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.report(cases.frame(spark, rows), bench).collect()}
    assert got == {(k, k) for k in range(30)}


def test_items_of_one_word(spark):
    docs = cases.frame(spark, [(1, "some text with zebra in it"), (2, "some text"), (3, "Zebra")])
    bench = spark.createDataFrame([(7, "zebra"), (8, "Ox ox")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.report(docs, bench).collect()}
    assert got == {(1, 7), (3, 7)}
    assert [r.doc_id for r in decontaminate.reject(docs, bench).collect()] == [2]


def test_marks_of_any_script_part_words():
    want = ["the", "answer", "is", "here"]
    for text in ("“The” answer… *is* here", "«the» ‘answer’ —is— ¿here?", "'the' _answer_ (is) ¡here!", "the、answer。is–here"):
        assert decontaminate.words_of(text) == want


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(50):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(15))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.common_subsequence(a, b) == table[-1, -1]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = cases.frame(spark, [(1, "some text"), (2, None)])
    some = spark.createDataFrame([(1, "some text with words")], none.schema)
    assert decontaminate.report(docs, none).count() == 0
    assert decontaminate.report(cases.empty(spark), some).count() == 0
    assert decontaminate.reject(cases.empty(spark), some).count() == 0
    assert decontaminate.reject(docs, none).count() == 2


def test_leaks_equal_every_item_against_every_window(spark):
    """Subsequences of all items with the words around all windows, no candidates in between."""
    rng = random.Random(31)
    vocabulary = ["w%d" % k for k in range(120)]
    items = [(k, [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 8, 9, 20, 33]))]) for k in range(25)]
    rows = []
    for d in range(90):
        host = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 90))]
        for _ in range(rng.randrange(3)):
            words = list(rng.choice(items)[1])
            # Near the bounds: words lost, replaced or moved apart.
            for _ in range(rng.randrange(1 + len(words) // 2)):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], ["x"], [words[at], "x", "y"]])
                words = words or ["x"]
            cut = rng.randrange(len(host) + 1)
            host[cut:cut] = words
        rows.append((d, " ".join(host)))

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                row[j], last = (last + 1 if x == y else max(row[j], row[j - 1])), row[j]
        return row[-1]

    want = set()
    for d, text in rows:
        words = text.split()
        for k, own in items:
            width = max(8, 1 << (len(own) - 1).bit_length())
            tail = own[-max(1, -(-len(own) // 4)) :]
            for start in range(-width // 2, len(words), width // 2):
                part = words[max(0, start - width // 2) : start + width + width // 2]
                lcs = common(own, part) / len(own)
                if lcs >= 0.8 or (lcs >= 0.6 and common(tail, part) / len(tail) >= 0.8):
                    want.add((d, k))
                    break
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.report(cases.frame(spark, rows), bench).collect()}
    assert got == want and len(want) > 60


def test_numbers_of_words_in_any_text():
    rng = random.Random(41)
    letters = [*"abcABCéÉßİΣñÑж日", *decontaminate.PARTING, *decontaminate.ASCII_SPACE, "\0"]
    plain = [*"abÀ", " ", "\n", "\t", ".", "-", "\x1c", "\xa0"]
    texts = ["", " ", "…", "a", " a  b ", "\x1c\x85a\u2003b\u3000"]
    texts += ["".join(rng.choice(x) for _ in range(rng.randrange(40))) for x in [letters, plain] * 300]

    def words(text):
        return "".join(" " if c in decontaminate.MARKS else c for c in text.lower()).split()

    assert [decontaminate.words_of(t) for t in texts] == list(map(words, texts))
    different = sorted({w for t in texts for w in words(t)})
    vocabulary = {w: k for k, w in enumerate(different[::2])}
    numbers, sizes = decontaminate.Reader(vocabulary)(texts)
    assert sizes.tolist() == [len(words(t)) for t in texts]
    assert numbers.tolist() == [vocabulary.get(w, -1) for t in texts for w in words(t)]
    numbers, sizes = decontaminate.Reader(vocabulary)(["", "?"])
    assert len(numbers) == 0 and sizes.tolist() == [0, 0]


def test_reading_takes_less_than_a_look_up_per_word():
    rng = random.Random(43)
    texts = [cases.words(rng, 500, 3000) + (" Größe, déjà vu." if k % 2 else ".") for k in range(300)]
    vocabulary = {w: k for k, w in enumerate(sorted({w for t in texts for w in t.split()})[::2])}
    read = decontaminate.Reader(vocabulary)

    def plain(texts):
        for t in texts:
            words = decontaminate.words_of(t)
            np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int32, len(words))

    def least(run):
        took = []
        for _ in range(7):
            began = time.process_time()
            run(texts)
            took.append(time.process_time() - began)
        return min(took)

    assert least(read) < 0.8 * least(plain)


def test_projection_equals_all_passages(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "GATHERED", 10_000)
    monkeypatch.setattr(decontaminate, "PAIRS", 500)
    rows, items, _ = planted(60)
    block = decontaminate.Block([(k, decontaminate.words_of(t)) for k, t in items])
    docs, terms = cases.frame(spark, rows, True).repartition(3), len(block.vocabulary)
    met = []
    for _, text in rows:
        words = decontaminate.words_of(text or "")
        for a in range(0, len(words), 32):
            numbers = [block.vocabulary[w] for w in words[a : a + 32] if w in block.vocabulary]
            met.append(np.bincount(numbers, minlength=terms))
    met = np.array(met)
    passages, containing = decontaminate.count(docs, block.vocabulary)
    assert passages == len(met) and (containing == (met > 0).sum(0)).all()
    block.weigh(passages, containing)
    weighed = met * block.idf
    want = weighed.T @ (weighed @ block.basis)
    assert np.allclose(decontaminate.project(docs, block), want, rtol=0, atol=1e-12 * abs(want).max())


def test_groups_of_windows_lose_no_item():
    rng = np.random.default_rng(47)
    for n, dense in ((1, 0.5), (3, 0.1), (4, 0.3), (1201, 0.05), (601, 0.6)):
        rows, items = (rng.random((k, decontaminate.BITS)) < dense for k in (n, 30))
        least = rng.integers(1, np.maximum(2, items.sum(1) // 3), dtype=np.uint16)
        rows[::5] |= items[rng.integers(0, 30, len(rows[::5]))]
        want = np.argwhere((rows[:, None] & items).sum(2) >= least).tolist()
        packed = [np.packbits(x, axis=1).view(np.uint64) for x in (rows, items)]
        got = decontaminate.enough(*packed, least)
        assert np.stack(got, axis=1).tolist() == want
    half = np.array([3, 4, 6, 7, 9, 12])
    own = rng.integers(0, 1 << 60, (6, decontaminate.LANES), dtype=np.uint64)
    sets = dict(zip(half.tolist(), own))
    want = [
        np.bitwise_or.reduce([sets[h + away] for away in (-1, 0, 1, 2) if h + away in sets])
        for h in half.tolist()
    ]
    assert (decontaminate.neighbours(half, own) == np.array(want)).all()
