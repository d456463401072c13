import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpuscope.llm import packing, tokens

from . import cases

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_ids_are_the_tokenizers(spark):
    rng = random.Random(6)
    plain, mine = Tokenizer.from_file(PATH), tokens.Encoder(PATH)
    parts = ["it's", "WE'LL", " ", "\n", "\t", "é", "ÄÖ", "straße", "²3", "½", "123", "!?'s", "'", "''t", "<|endoftext|>",
             "<|", "日本", "Σς", "İ", "\x1c", "\x85", "\xa0", " ", "é", "ŉ", "ǅ", "µª", "😀", "don't", "_a_b", "\x00", "x" * 300]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert list(np.frombuffer(mine(text), "<u4")) == plain.encode(text, add_special_tokens=False).ids, repr(text)
    for c in range(1, 0x250):
        for text in (f"a{chr(c)}b {chr(c)}1", chr(c) * 2):
            assert list(np.frombuffer(mine(text), "<u4")) == plain.encode(text, add_special_tokens=False).ids, hex(c)


@pytest.mark.parametrize("clashing", [False, True])
def test_pieces_restore_all_documents(spark, clashing):
    rows = cases.corpus(n=200)
    plain = Tokenizer.from_file(PATH)
    got = packing.pack(cases.frame(spark, rows, clashing).repartition(3), PATH).collect()
    want = collections.Counter()
    for d, t in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        want[d, ids] += 1
    # Documents of one id are told apart by their lengths here.
    pieces = collections.defaultdict(list)
    for r in got:
        d = None if r.doc == -(2**63) else r.doc
        pieces[d, r.doc_tokens].append((r.start, bytes(r.ids)))
        assert r.length == len(r.ids) // 4 > 0
    for (d, n), parts in pieces.items():
        same = [ids for (x, ids), k in want.items() for _ in range(k) if x == d and len(ids) == 4 * n]
        assert sum(len(p) for _, p in parts) == sum(map(len, same))
        if len(same) == 1:
            assert b"".join(p for _, p in sorted(parts)) == same[0]
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096 and at & at - 1 == 0


def test_level_with_the_smallest_sum_of_squares():
    rng = random.Random(1)
    packer = packing.Packer(20, most_open=1000)
    for k in range(300):
        size = rng.randrange(1, 20)
        before = packer.level.copy()
        costs = {}
        for h in range(21):
            if h == 0 or (before[h] and h + size <= 20):
                after = before.copy()
                if h:
                    after[h] -= 1
                if h + size < 20:
                    after[h + size] += 1
                costs[h] = int((after[:20] ** 2).sum())
        assert costs[packer._best(size)] == min(costs.values())
        list(packer.add(k, b"\0" * 4 * size))


def test_open_sequences_are_bounded():
    packer = packing.Packer(100, most_open=8)
    full = []
    for k in range(500):
        full += packer.add(k, b"abcd" * 51)
        assert packer.open <= 9
    full += packer.finish()
    assert sum(len(p[2]) for s in full for p in s) == 500 * 51 * 4


def test_digests_and_empty_table(spark):
    rows = [(1, "a b c"), (2, None)]
    got = packing.report(cases.frame(spark, rows), PATH).collect()
    assert {r.doc_id: r.doc_tokens for r in got} == {1: 4, 2: 1}
    assert zlib.crc32(np.array([2], "<u4").tobytes()) in [r.ids_crc32 for r in got if r.doc_id == 2]
    assert packing.report(cases.empty(spark), PATH).count() == 0


def test_memory_of_words_folds_and_forgets(monkeypatch):
    rng = random.Random(3)
    plain, mine = Tokenizer.from_file(PATH), tokens.Encoder(PATH)
    monkeypatch.setattr(tokens, "REMEMBERED", 20000)
    for k in range(30):
        texts = [cases.words(rng, 40, 500) + " x|y '' don't " + "long" * 30 for _ in range(5)]
        got = [list(np.frombuffer(ids, "<u4")) for ids in mine.each(texts)]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert mine.words.held <= 20000 and not any(len(w) > tokens.LONG for w in mine.words.ids)
        known = dict(mine.words.ids)
        if k % 3 == 0:
            mine.words.fold()
            assert not mine.words.ids
            mine.words.unfold()
            assert mine.words.ids == known


def test_most_tokens_stay_where_the_sum_of_squares_put_them():
    rng = random.Random(5)
    for n, most in ((120, 0.15), (1000, 0.05)):
        packer, total, full = packing.Packer(), 0, []
        for k in range(n):
            size = min(20000, int(rng.paretovariate(0.8) * 60))
            total += size
            full += packer.add(k, b"\0" * 4 * size)
        full += packer.finish()
        assert sum(len(p[2]) // 4 for s in full for p in s) == total
        assert packer.poured < most * total
