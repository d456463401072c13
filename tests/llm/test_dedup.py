import collections
import hashlib
import re
import zlib

import pytest
import xxhash

from corpuscope.llm import exact, sharding, simhash

from . import cases

low = lambda d: (d is None, d)


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_groups_match_brute_force(spark, clashing):
    rows = cases.corpus()
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[norm(t)].append(d)
    got = exact.report(cases.frame(spark, rows, clashing).repartition(11)).collect()
    assert len(got) == len(rows)
    seen = collections.Counter()
    for r in got:
        seen[r.text_sha256] += r.kept
    assert set(seen.values()) == {1} and len(seen) == len(groups)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): g for t, g in groups.items()}
    for r in got:
        group = by_digest[r.text_sha256]
        assert r.group_size == len(group) and r.keep_id == min(group, key=low)
        assert not r.kept or r.doc_id == r.keep_id


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_deduplication_keeps_one_whole_row(spark, clashing):
    rows = cases.corpus() + [(77777, "twice the same row")] * 3
    docs = cases.frame(spark, rows, clashing)
    left = exact.deduplicate(docs)
    assert left.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in left.collect()]
    want = {}
    for d, t in rows:
        if norm(t) not in want or low(d) < low(want[norm(t)]):
            want[norm(t)] = d
    assert sorted((norm(t), str(d)) for d, t in kept) == sorted((t, str(d)) for t, d in want.items())


def test_runs_merge_over_several_levels(spark):
    docs = spark.range(0, 900, 1, 70).selectExpr("id AS doc_id", "concat('t', id % 7) AS text")
    got = exact.report(docs).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(k, len(range(k, 900, 7))) for k in range(7)}


def word_print(text):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    grams = [b" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or ([b" ".join(found)] if found else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(rows):
    prints = [word_print(t) for _, t in rows]
    nodes = sorted(set(prints))
    root = {p: p for p in nodes}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for (d, _), p in zip(rows, prints):
        if d is not None:
            least[find(p)] = min(d, least.get(find(p), d))
    return sorted(
        (str(d), f"{p:016x}", str(least.get(find(p)))) for (d, _), p in zip(rows, prints)
    )


@pytest.mark.parametrize("bucket", [2, 256])
def test_simhash_components_match_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rows = cases.corpus()
    got = simhash.components(cases.frame(spark, rows, bucket == 2)).collect()
    assert sorted(
        (str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got
    ) == brute_components(rows)


@pytest.mark.parametrize("bucket", [1, 3, 10000])
def test_links_connect_what_differs_in_two_bits(spark, monkeypatch, bucket):
    import random

    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(3)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    prints = {0, (1 << 64) - 1}
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(6):
            prints.add(x)
            for _ in range(rng.randrange(1, 4)):
                x ^= 1 << rng.randrange(64)
    nodes = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    edges = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.links(nodes).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in edges)

    def classes(pairs):
        root = {p: p for p in prints}

        def find(p):
            while root[p] != p:
                p = root[p]
            return p

        for a, b in pairs:
            root[find(a)] = find(b)
        out = collections.defaultdict(set)
        for p in prints:
            out[find(p)].add(p)
        return sorted(map(sorted, out.values()))

    every = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    assert classes(edges) == classes(every)


@pytest.mark.parametrize("clashing", [False, True])
def test_shards_are_even_gapless_and_keep_equal_texts(spark, clashing):
    rows = cases.corpus(n=900)
    got = sharding.report(cases.frame(spark, rows, clashing), shards=8).collect()
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == sorted(
        (str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows
    )
    load, slots, homes = collections.Counter(), collections.defaultdict(list), {}
    text = {(str(d), zlib.crc32((t or "").encode())): t or "" for d, t in rows}
    for r in got:
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        assert homes.setdefault(text[str(r.doc_id), r.text_crc32], r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # One document is larger than a share, so the others fill the rest evenly.
    assert len(load) == 8


def test_a_group_of_a_third_of_the_rows_is_spread(spark):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, repeat('same ', 40), concat(repeat('x', 200), id)) AS text"
    )
    load = collections.Counter()
    for r in sharding.report(docs).collect():
        load[r.shard] += r["size"]
    assert len(load) == 16 and max(load.values()) < 1.03 * min(load.values())


@pytest.mark.parametrize("query", [exact.report, simhash.components, sharding.report, exact.deduplicate])
def test_empty_table(spark, query):
    assert query(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("n,shards", [(400, 16), (60, 4)])
def test_shards_and_slots_match_brute_force(spark, n, shards):
    import random

    rng = random.Random(n)
    rows = [(k, cases.words(rng, rng.choice([1, 3, 20, 60, 300]))) for k in range(n)]
    rows += [(n + k, rows[k % 7][1]) for k in range(30)] + [(n + 50, None), (n + 51, "")]
    size = {d: len((t or "").encode()) + 1 for d, t in rows}
    total = sum(size.values())
    share = total / shards
    units = collections.defaultdict(list)
    for d, t in rows:
        units[hashlib.sha256((t or "").encode()).hexdigest()].append(d)
    # No group here is larger than a share, so none is broken.
    weight = {u: sum(size[d] for d in docs) for u, docs in units.items()}
    assert max(weight.values()) <= share
    home, load = {}, [0] * shards
    for w, u in sorted(((weight[u], u) for u in units if weight[u] > share / 64), reverse=True):
        home[u] = min(range(shards), key=lambda k: (load[k], k))
        load[home[u]] += w
    room = [max(0.0, share - x) for x in load]
    scale = (total - sum(load)) / (sum(room) or 1)
    cuts, at = [], 0.0
    for r in room[:-1]:
        at += r * scale
        cuts.append(at)
    before = 0
    for u in sorted((u for u in units if u not in home), key=lambda u: (min(units[u]), u)):
        home[u] = sum(before + weight[u] / 2 >= c for c in cuts)
        before += weight[u]
    shard = {d: home[u] for u, docs in units.items() for d in docs}
    slots = collections.defaultdict(list)
    for d in sorted(shard):
        slots[shard[d]].append(d)
    want = sorted((d, size[d], s, slots[s].index(d)) for d, s in shard.items())
    got = sharding.report(cases.frame(spark, rows).repartition(5), shards).collect()
    assert sorted((r.doc_id, r["size"], r.shard, r.slot) for r in got) == want
