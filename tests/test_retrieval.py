import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuscope.config import EngineConfig
from corpuscope.functions.parsing import text_of
from corpuscope.operators import evaluation, terms
from corpuscope.operators.filters import to_column, to_json
from corpuscope.operators.nearest import (
    nearest,
    nearest_approximate,
    nearest_diverse,
    question_warnings,
    recall,
)

DIM = 8
EMBEDDED = "row_id long, embedding array<float>, label int, owner string"


def vectors(n, seed, copies=0):
    """``n`` random vectors; the first ``copies`` of them are the same."""
    m = np.random.default_rng(seed).normal(size=(n, DIM)).astype(np.float32)
    m[:copies] = m[0]
    return m


def frames(spark, rows, questions, **columns):
    label = lambda i: i % 4
    owner = lambda i: None if i % 5 == 0 else f"o{i % 3}"
    data = [(i, r.tolist(), label(i), owner(i)) for i, r in enumerate(rows)]
    asked = [(i, q.tolist(), *[c[i] for c in columns.values()]) for i, q in enumerate(questions)]
    schema = "query_id long, embedding array<float>" + "".join(
        f", {name} {'int' if name == 'limit' else 'string'}" for name in columns
    )
    return (
        spark.createDataFrame(asked, schema).repartition(2),
        spark.createDataFrame(data, EMBEDDED).repartition(5),
    )


def scores(rows, questions, metric):
    r, q = rows.astype(float), questions.astype(float)
    if metric == "l2":
        return -np.sqrt(((q[:, None, :] - r[None, :, :]) ** 2).sum(-1))
    r /= np.linalg.norm(r, axis=1, keepdims=True)
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    return q @ r.T


def brute(rows, questions, k, metric, keep=lambda q, r: True, limit=lambda q: 10**9):
    s = np.round(scores(rows, questions, metric), 6) + 0.0
    out = {}
    for q in range(len(questions)):
        order = sorted((i for i in range(len(rows)) if keep(q, i)), key=lambda i: (-s[q, i], i))
        out[q] = [(i, s[q, i]) for i in order[: min(k, limit(q))]]
    return out


def collected(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.row_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


CELLS = EngineConfig(broadcast_bytes=0, cell_rows=30)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("config", [EngineConfig(), CELLS])
def test_exact_with_a_third_of_copies(spark, metric, config):
    rows, questions = vectors(200, 1, copies=70), vectors(70, 2, copies=25)
    questions[0] = rows[0]  # the copies are the best answer: ties decide
    got = collected(nearest(*frames(spark, rows, questions), 5, metric, config))
    assert got == brute(rows, questions, 5, metric)


@pytest.mark.parametrize("config", [EngineConfig(), CELLS])
def test_filters_and_limits_per_question(spark, config):
    rows, questions = vectors(120, 3), vectors(40, 4)
    specs = [
        None,
        {"eq": ["label", 2]},
        {"and": [{"in": ["owner", ["o1", "o2"]]}, {"gt": ["label", 0]}]},
        {"or": [{"ne": ["owner", "o1"]}, {"lte": ["label", 0]}]},
        {"eq": ["owner", 'no "such": ["owner"'] },
    ]
    label, owner = (lambda i: i % 4), (lambda i: None if i % 5 == 0 else f"o{i % 3}")
    rules = [
        lambda i: True,
        lambda i: label(i) == 2,
        lambda i: owner(i) in ("o1", "o2") and label(i) > 0,
        lambda i: (owner(i) is not None and owner(i) != "o1") or label(i) <= 0,
        lambda i: False,
    ]
    filters = [to_json(specs[q % 5]) for q in range(40)]
    limits = [None if q % 3 == 0 else q % 3 for q in range(40)]
    got = collected(
        nearest(*frames(spark, rows, questions, filter=filters, limit=limits), 6, "cosine", config)
    )
    want = brute(
        rows, questions, 6, "cosine", lambda q, i: rules[q % 5](i),
        lambda q: 10**9 if q % 3 == 0 else q % 3,
    )
    assert got == {q: found for q, found in want.items() if found}
    # The same filters as predicates of the scan.
    _, df = frames(spark, rows, questions)
    for spec, rule in zip(specs[1:], rules[1:]):
        ids = {r.row_id for r in df.where(to_column(spec)).collect()}
        assert ids == {i for i in range(120) if rule(i)}


def test_filter_errors():
    with pytest.raises(ValueError):
        to_column({"eq": ["page", 1]}, ("source",))
    with pytest.raises(ValueError):
        to_column({"like": ["source", 1]})


def test_nothing_to_search(spark):
    questions, rows = frames(spark, vectors(3, 1), vectors(2, 2))
    assert nearest(questions, rows.where("false"), 3).count() == 0
    assert nearest(questions.where("false"), rows, 3).count() == 0


def greedy(rows, questions, k, fetch_k, weight):
    alike = np.round(scores(rows, rows, "cosine"), 6)
    out = {}
    for q, best in brute(rows, questions, fetch_k, "cosine").items():
        left, picked = list(best), []
        while left and len(picked) < k:
            gain = lambda c: round(
                weight * c[1]
                - (1 - weight) * max((alike[c[0], p[0]] for p in picked), default=0.0), 9
            )
            choice = max(left, key=lambda c: (gain(c), -left.index(c)))
            picked.append(choice)
            left.remove(choice)
        out[q] = picked
    return out


def test_diversity(spark):
    rows, questions = vectors(80, 5, copies=10), vectors(12, 6)
    both = frames(spark, rows, questions)
    assert collected(nearest_diverse(*both, k=8, fetch_k=20)) == greedy(rows, questions, 8, 20, 0.5)
    assert collected(nearest_diverse(*both, k=8, weight=1.0)) == brute(rows, questions, 8, "cosine")


def test_approximate(spark):
    rows, questions = vectors(300, 7, copies=100), vectors(40, 8)
    questions[1] = rows[0]
    questions, df = frames(spark, rows, questions)
    exact = nearest(questions, df, 5, "l2")
    wide = nearest_approximate(questions, df, 5, width=1, bucket_length=1000.0, config=CELLS)
    # Two huge buckets per table, cut into cells: no cell may lose a row.
    assert collected(wide) == collected(exact)
    narrow = recall(nearest_approximate(questions, df, 5, bucket_length=1.0, config=CELLS), exact)
    row = narrow.first()
    assert row.n_expected == 200 and 0 < row.recall <= 1


# --- terms -------------------------------------------------------------------
TEXTS = ["the cat sat on the mat", "The dog; the DOG!", "", "été n'est pas l'hiver", "cat cat 42 x_y"]


def tfidf(texts):
    bags = [[t for t in re.split(r"[^\w]+", text.lower()) if t] for text in texts]
    df = {t: sum(t in b for b in bags) for b in bags for t in b}
    out = []
    for b in bags:
        raw = {t: b.count(t) * math.log((len(texts) + 1) / (df[t] + 1)) for t in b}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        out.append({t: w / norm if norm else 0.0 for t, w in raw.items()})
    return out


@pytest.mark.parametrize("limit", [1_000_000, 2, 1])
def test_weights(spark, limit):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "row_id long, page_content string")
    config = EngineConfig(broadcast_terms=limit)
    got = terms.vectors(docs, terms.fit(docs), config=config).collect()
    want = tfidf(TEXTS)
    assert {r.row_id for r in got} == {0, 1, 2, 3, 4}
    for r in got:
        weights = dict(zip(r.terms, r.weights))
        assert weights.keys() == want[r.row_id].keys()
        assert all(abs(weights[t] - want[r.row_id][t]) < 1e-12 for t in weights)


@pytest.mark.parametrize("limit", [1_000_000, 3])
@pytest.mark.parametrize("cells", [False, True])
def test_text_search_with_hot_terms(spark, limit, cells):
    rng = np.random.default_rng(9)
    # Word 0 is in every text, a third of the texts are copies.
    texts = ["w0 " + " ".join(f"w{v}" for v in rng.zipf(1.5, 30) % 50) for _ in range(120)]
    texts[:40] = [texts[0]] * 40
    asked = ["w1 w3 unknown", "w0", "w7 w7 w2", texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "row_id long, page_content string")
    questions = spark.createDataFrame(list(enumerate(asked)), "query_id long, question string")
    from corpuscope.plans.ask import question_vectors

    config = EngineConfig(
        broadcast_terms=limit, broadcast_bytes=10_000 if not cells else 500, cell_rows=25
    )
    vocabulary = terms.fit(docs)
    rows = terms.vectors(docs, vocabulary, config=config)
    asked_vectors = question_vectors(questions, vocabulary, config)
    got = collected(nearest(asked_vectors, rows, 5, "terms", config))

    weights = tfidf(texts)
    df = {}
    for text in texts:
        for t in set(text.split()):
            df[t] = df.get(t, 0) + 1
    for q, text in enumerate(asked):
        bag = text.split()
        raw = {t: bag.count(t) * math.log((len(texts) + 1) / (df.get(t, 0) + 1)) for t in bag}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        s = [
            round(sum(raw[t] / norm * w.get(t, 0) for t in raw), 6) if norm else 0 for w in weights
        ]
        order = sorted((i for i in range(len(texts)) if s[i] > 0), key=lambda i: (-s[i], i))[:5]
        assert got.get(q, []) == [(i, pytest.approx(s[i], abs=1e-6)) for i in order]


# --- evaluation --------------------------------------------------------------
def test_quality_measures(spark):
    golden = spark.createDataFrame(
        [("a", ["x", "y"]), ("b", ["z"]), ("c", ["w"]), ("d", ["v"])],
        "query_id string, expected_ids array<string>",
    )
    results = spark.createDataFrame(
        [("a", 1, "q"), ("a", 2, "y"), ("a", 3, "x"), ("b", 1, "z"), ("c", 1, "z")],
        "query_id string, rank int, doc_id string",
    )
    per = evaluation.per_question(evaluation.mark_expected(results, golden))
    assert {r.query_id: (r.hit, r.reciprocal_rank) for r in per.collect()} == {
        "a": (True, 0.5), "b": (True, 1.0), "c": (False, 0.0), "d": (False, 0.0),
    }
    row = evaluation.summary(per).first()
    assert (row.n_questions, row.hit_rate, row.mrr) == (4, 0.5, 0.375)
    assert not row.hit_rate_ok and not row.mrr_ok
    found = {r.query_id: r.found_all for r in evaluation.containment(results, golden).collect()}
    assert found == {"a": True, "b": True, "c": False, "d": False}


def test_text_that_arrow_cannot_carry():
    assert text_of("a\ud800b") == "a?b" and text_of(None) is None and text_of(True) == "True"


def test_limit_above_k_is_honoured(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)], "row_id long, embedding array<double>")
    asked = spark.createDataFrame(
        [(1, [1.0, 0.0], 10), (2, [0.0, 1.0], None), (3, [1.0, 1.0], 0)],
        "query_id long, embedding array<double>, limit int",
    )
    for config in (EngineConfig(), EngineConfig(broadcast_bytes=0, cell_bytes=200)):
        got = nearest(asked, rows, 4, "l2", config).groupBy("query_id").count().collect()
        assert {r.query_id: r["count"] for r in got} == {1: 10, 2: 4}
    picked = nearest_diverse(asked, rows, 4, "cosine").groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in picked} == {1: 10, 2: 4}


def test_questions_made_from_the_rows(spark):
    both = spark.createDataFrame(
        [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)], "row_id long, embedding array<double>"
    )
    asked = both.withColumnRenamed("row_id", "query_id")
    want = sorted(map(tuple, nearest(asked, both, 3).collect()))
    cells = nearest(asked, both, 3, "cosine", EngineConfig(broadcast_bytes=0, cell_bytes=400))
    assert sorted(map(tuple, cells.collect())) == want
    assert "NestedLoop" not in cells._jdf.queryExecution().toString()
    assert nearest_approximate(asked, both, 3).where("query_id = row_id").count() > 0


def test_distances_of_long_vectors_and_vectors_of_other_lengths(spark):
    rows = spark.createDataFrame(
        [(1, [1e4, 2e4, 3e4]), (2, [1e4, 2e4, 3e4 + 1e-3]), (3, [1.0, 2.0]), (4, None)],
        "row_id long, embedding array<double>",
    )
    asked = rows.where("row_id = 1").withColumnRenamed("row_id", "query_id")
    got = {r.row_id: r.score for r in nearest(asked, rows, 5, "l2").collect()}
    assert got == {1: 0.0, 2: -0.001}


@pytest.mark.parametrize("kind", ["cosine", "l2"])
def test_questions_of_mixed_lengths(spark, kind):
    vectors = [[1.0, 2.0], [3.0, 1.0, 2.0], [2.0], [4.0, 1.0], []]
    rows = spark.createDataFrame(list(enumerate(vectors)), "row_id long, embedding array<double>").coalesce(1)
    asked = rows.withColumnRenamed("row_id", "query_id")
    for config in (EngineConfig(), EngineConfig(broadcast_bytes=0, cell_bytes=200)):
        got = nearest(asked, rows, 5, kind, config).collect()
        best = {r.query_id: (r.row_id, r.score) for r in got if r["rank"] == 1}
        assert best == {k: (k, 1.0 if kind == "cosine" else 0.0) for k in range(4)}
        assert sorted((r.query_id, r.row_id) for r in got) == [(0, 0), (0, 3), (1, 1), (2, 2), (3, 0), (3, 3)]
    warned = question_warnings(asked, rows).collect()
    assert {r["class"] for r in warned} == {"vector_length"}
    assert {r.query_id: r.message.split()[0] for r in warned} == {0: "3", 1: "4", 2: "4", 3: "3", 4: "4"}


def test_bad_filters_do_not_touch_other_questions(spark):
    rows = spark.createDataFrame([(i, [1.0, float(i)], "ab"[i % 2]) for i in range(6)],
                                 "row_id long, embedding array<double>, owner string")
    specs = [None, '{"eq": ["owner", "a"]}', "{", '{"eq": ["nobody", 1]}', '{"lt": ["owner", 3]}', '{"and": []}', "[1]"]
    asked = spark.createDataFrame([(k, [0.0, 1.0], s) for k, s in enumerate(specs)],
                                  "query_id long, embedding array<double>, filter string")
    got = {r.query_id: r["count"] for r in nearest(asked, rows, 9).groupBy("query_id").count().collect()}
    assert got == {0: 6, 1: 3}
    assert sorted(r.query_id for r in question_warnings(asked, rows).collect()) == [2, 3, 4, 5, 6]


@pytest.mark.parametrize("splits", [4, 64])
def test_candidates_do_not_grow_with_the_splits(spark, splits):
    from corpuscope.operators import nearest as module

    rows = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(640)], "row_id long, embedding array<double>")
    asked = module._question_columns(rows.limit(5).withColumnRenamed("row_id", "query_id"), rows, "cosine")
    found = module._against_broadcast(asked, rows.repartition(splits), 3, "cosine", EngineConfig(tasks_per_core=1))
    assert found.count() <= 4 * 5 * 3
