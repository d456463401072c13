"""What scoring costs: pairs scored in full, copies, and cells."""

import numpy as np
import pyarrow as pa
import pytest

from corpuscope.config import EngineConfig
from corpuscope.functions import topk
from corpuscope.operators import nearest as module
from corpuscope.operators.nearest import nearest
from tests.test_retrieval import brute, collected, frames, scores, vectors


def _table(key, m, **more):
    vectors_of = pa.array(list(m), pa.list_(pa.float32()))
    return pa.table({key: pa.array(np.arange(len(m))), "embedding": vectors_of, **more})


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_few_pairs_are_scored_in_full(monkeypatch, metric):
    rows, questions = vectors(6000, 1), vectors(300, 2)
    scored = []
    exact = topk.DenseScorer._exact
    monkeypatch.setattr(
        topk.DenseScorer, "_exact",
        lambda self, q, x, d, y: (scored.append(len(x)), exact(self, q, x, d, y))[1],
    )
    asked = _table("query_id", questions, limit=pa.nulls(300, pa.int32()))
    batches = _table("row_id", rows).to_batches(max_chunksize=1000)
    found = topk.score_batches(batches, asked, metric, 5, pa.int64())
    want = brute(rows, questions, 5, metric)
    assert found["row_id"].to_pylist() == [i for q in range(300) for i, _ in want[q]]
    assert 0 < sum(scored) < 300 * 6000 / 20


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("scale", [1e-25, 1e-3, 1e8, 1e30])
def test_numbers_of_any_size(metric, scale):
    rows = vectors(400, 3, copies=50).astype(np.float64) * scale
    rows[60:90, 0] += 1000 * scale  # far from the origin, near each other
    questions = rows[40:80]
    lists = pa.list_(pa.float64())
    asked = pa.table({
        "query_id": pa.array(range(40)), "embedding": pa.array(list(questions), lists),
        "limit": pa.nulls(40, pa.int32()),
    })
    given = pa.table({"row_id": pa.array(range(400)), "embedding": pa.array(list(rows), lists)})
    found = topk.score_batches(given.to_batches(max_chunksize=90), asked, metric, 7, pa.int64())
    s = np.round(scores(rows, questions, metric), 6) + 0.0
    want = [i for q in range(40) for i in sorted(range(400), key=lambda i: (-s[q, i], i))[:7]]
    got = found["row_id"].to_pylist()
    # Scores of 1e8 and more have fewer digits than are rounded to.
    if scale < 1 or metric == "cosine":
        assert got == want
    else:
        pairs = [(n // 7, i) for n, i in enumerate(got)]
        expected = [(n // 7, i) for n, i in enumerate(want)]
        assert np.allclose([s[p] for p in pairs], [s[p] for p in expected], rtol=1e-9)


@pytest.mark.parametrize("config", [EngineConfig(), EngineConfig(broadcast_bytes=0)])
def test_copies_are_scored_once(spark, monkeypatch, config):
    rows, questions = vectors(400, 5), vectors(400, 6)
    rows[100:300], rows[350] = rows[0], 0.0  # half of the rows are copies
    questions[:300] = rows[:300]
    questions[390:] = -0.0
    questions[395:] = 0.0
    seen, plain = [], module._candidates

    def counted(asked, some, *rest):
        seen.append((asked.count(), some.count()))
        return plain(asked, some, *rest)

    monkeypatch.setattr(module, "_candidates", counted)
    limits = [None if q % 2 else 3 for q in range(400)]
    got = collected(nearest(*frames(spark, rows, questions, limit=limits), 5, "l2", config))
    want = brute(rows, questions, 5, "l2", limit=lambda q: 10**9 if q % 2 else 3)
    assert got == want
    # Five of the copies stay; each different question is asked once for each of both limits.
    assert seen == [(100 + 1 + 90 + 2, 200 + 5 - 1)]


def test_cells_follow_the_tasks():
    config = EngineConfig(broadcast_bytes=0, cell_bytes=128 << 10)
    small = module._cuts([1 << 20, 1 << 20], 64, config)
    assert small == [8, 8]
    for size in (10 << 20, 60 << 20, 300 << 20):
        a, b = module._cuts([size, size], 48, config)
        assert 1 < a * b <= 48
    # No side of a cell passes its bound, however large the input.
    assert module._cuts([64 << 30, 1 << 20], 48, config)[0] >= 1024
    assert module._cuts([64 << 30, 64 << 30], 48, EngineConfig()) == [1024, 1024]


@pytest.mark.parametrize("config", [EngineConfig(tasks_per_core=16), EngineConfig(broadcast_bytes=0)])
@pytest.mark.parametrize("pairs", [1 << 30, 1500])
def test_tasks_grow_in_number_and_not_in_length(spark, monkeypatch, config, pairs):
    rows, questions = vectors(400, 7), vectors(300, 8)
    monkeypatch.setattr(module, "MOST_PAIRS", pairs)
    held, some = frames(spark, rows, questions)
    asked = module._question_columns(held, some, "cosine")
    size = module._look_at(asked, "cosine", some)[0]
    found = module._candidates(asked, some.select("row_id", "embedding"), size, 5, "cosine", config)
    tasks = found.rdd.getNumPartitions()
    assert tasks >= 300 * 400 / pairs
    # Cut on both sides: a question meets the root of the tasks, and each sends on five rows.
    assert found.count() <= 300 * 5 * (1 + tasks**0.5)
    assert collected(nearest(held, some, 5, "cosine", config)) == brute(rows, questions, 5, "cosine")
