import random
import zlib

import numpy as np

from corpuscope.llm import classifier, toxicity

from . import cases


def test_non_negative_risk_learns_from_positive_and_unlabelled():
    rng = random.Random(0)
    bad = ["foulword", "nastier", "vilething"]

    def text(toxic):
        words = cases.words(rng, 40, 300).split()
        for _ in range(4 if toxic else 0):
            words[rng.randrange(40)] = rng.choice(bad)
        return " ".join(words)

    weights, bias = classifier.train(
        [text(True) for _ in range(60)], [text(k % 8 == 0) for k in range(400)], 0.125
    )
    score = toxicity.scorer((weights, bias))
    assert np.mean([score(text(True)) >= 0.3 for _ in range(50)]) > 0.9
    assert np.mean([score(text(False)) < 0.3 for _ in range(50)]) > 0.9
    assert 0 < score("") < 0.3


def toxic_corpus():
    rng = random.Random(2)
    rows = cases.corpus(n=300)
    labels = []
    for i in range(600):
        toxic = i % 6 == 0
        words = cases.words(rng, 50, 500).split()
        for _ in range(5 if toxic else 0):
            words[rng.randrange(50)] = rng.choice(["foulword", "nastier", "vilething"])
        rows.append((10000 + i, " ".join(words)))
        labels.append((10000 + i, 1, int(toxic)))
    return rows, labels + [(None, 0, 0), (4, None, None), (10001, 1, 0)]


def test_held_out_accuracy(spark):
    rows, labels = toxic_corpus()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = cases.frame(spark, rows, True)
    got = toxicity.report(docs, table).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(text.encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    want = {d: t for d, _, t in labels if d is not None and t is not None}
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert np.mean([r.predicted == want[r.doc_id] for r in held]) > 0.95
    model = toxicity.fit(docs, table)
    left = toxicity.reject(docs, model, 0.3)
    assert left.columns == docs.columns
    assert left.count() == sum(r.score < 0.3 for r in got)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = cases.frame(spark, cases.corpus(n=10))
    assert {r.score for r in toxicity.report(docs, none).collect()} == {0.0}
    assert toxicity.report(cases.empty(spark), none).count() == 0
    some = spark.createDataFrame([(1, 1, 1)], none.schema)
    assert toxicity.report(cases.empty(spark), some).count() == 0


def test_choice_of_text_and_labels_is_fixed(spark):
    """Several texts of one id, in any order, and labels without an id change nothing."""
    rows, labels = toxic_corpus()
    rows += [(10000 + i, "another text of this id %d" % i) for i in range(0, 600, 6)]
    labels += [(None, 1, 1)] * 5
    models = []
    for order in (1, -1):
        docs = cases.frame(spark, rows[::order]).repartition(3)
        marked = spark.createDataFrame(labels[::order], "doc_id long, quality int, toxic int")
        weights, bias = toxicity.fit(docs, marked)
        models.append((bias, sorted(weights.items())))
    assert abs(models[0][0] - models[1][0]) < 1e-9
    assert [f for f, _ in models[0][1]] == [f for f, _ in models[1][1]]
    assert np.allclose([w for _, w in models[0][1]], [w for _, w in models[1][1]], atol=1e-9)
