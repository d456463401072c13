import random

import pytest

import corpus_pipeline
from corpuscope.llm import queries

from . import cases
from .test_dedup import brute_components, word_print
from .test_toxicity import toxic_corpus


@pytest.mark.parametrize("clashing", [False, True])
def test_stages(spark, tmp_path, clashing):
    rng = random.Random(12)
    rows, labels = toxic_corpus()
    items = [(k, cases.words(rng, 40, 9000)) for k in range(10)]
    leaks = []
    for k in range(10):
        host = cases.words(rng, 100, 9000).split()
        leaks.append((20000 + k, " ".join(host[:50] + items[k][1].split() + host[50:])))
    rows += leaks
    folder = str(tmp_path)
    cases.frame(spark, rows, clashing).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    left = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in docs.collect()] if k < 4 else None
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/out-{k}")
        docs = spark.read.parquet(f"{folder}/out-{k}")
        if k < 4:
            assert docs.columns == columns
            left[name] = before, [(r.doc_id, r.text) for r in docs.collect()]
    toxic = {d for d, _, t in labels if t == 1}
    before, after = left["toxicity"]
    kept = {d for d, _ in after}
    assert sum(d in kept for d in toxic) <= 0.05 * len(toxic)
    assert len(after) >= 0.97 * len([r for r in before if r[0] not in toxic])
    before, after = left["exact_dedup"]
    assert len(after) == len({" ".join(f"|{t or ''}|".split()) for _, t in before})
    before, after = left["near_dedup"]
    least = {}
    for (d, t), (_, fp, group) in zip(
        sorted(before, key=lambda r: (str(r[0]), f"{word_print(r[1]):016x}")), brute_components(before)
    ):
        assert f"{word_print(t):016x}" == fp
        least[group] = min(least.get(group, (True, 0, "")), (d is None, d or 0, t or ""))
    assert sorted((str(d), t or "") for d, t in after) == sorted(
        ("None" if null else str(d), t) for null, d, t in least.values()
    )
    before, after = left["decontamination"]
    assert {d for d, _ in before} - {d for d, _ in after} == {d for d, _ in leaks}
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == {d for d, _ in after}
    assert {"start", "length", "sequence_id", "offset"} < set(docs.columns)


def test_every_operator_and_the_pipeline_is_registered():
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(names) == sorted([*(f"op{k}" for k in range(1, 14)), "pipeline"])
    assert set(queries.ORACLES) < set(queries.QUERIES)


def test_near_dedup_keeps_one_whole_row(spark):
    from corpuscope.llm import simhash

    # Two groups with one smallest id could not be told apart here.
    rows = [r for r in cases.corpus() if r[1] != "other text of the same id"]
    rows += [(-99, "seen three times as the same row")] * 3
    docs = cases.frame(spark, rows, clashing=True)
    left = simhash.deduplicate(docs)
    assert left.columns == docs.columns
    groups = {c for _, _, c in brute_components(rows)}
    kept = [(str(r.doc_id), r.text) for r in left.collect()]
    assert len(kept) == len(groups) and {d for d, _ in kept} == groups
    assert simhash.deduplicate(cases.empty(spark)).count() == 0
