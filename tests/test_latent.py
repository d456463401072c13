import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuscope.operators import coarse, evaluation, latent, postings, terms
from corpuscope.operators.nearest import nearest
from corpuscope.plans.ask import ask, question_vectors, retrieve
from corpuscope.plans.index import write_collection
from corpuscope.plans.ingest import ingest
from corpuscope.sources.collections import open_collection


def dense_matrix(vectors, model):
    place = {t: k for k, t in enumerate(model.terms.to_pylist())}
    rows = vectors.orderBy("row_id").collect()
    x = np.zeros((len(rows), len(place)))
    for i, r in enumerate(rows):
        for t, w in zip(r.terms, r.weights):
            if t in place:
                x[i, place[t]] = w
    return x, np.array([r.embedding for r in rows]) if "embedding" in vectors.columns else None


def corpus(spark, n=150, seed=1):
    rng = random.Random(seed)
    rows = [(k, " ".join("w%d" % int(rng.paretovariate(0.7)) for _ in range(rng.randrange(0, 30)))) for k in range(n)]
    return spark.createDataFrame(rows + [(n, None), (n + 1, "")], "row_id long, page_content string")


def test_singular_values_and_fixed_signs(spark):
    docs = corpus(spark)
    vocabulary, model = latent.fit_documents(docs, rank=20, most_terms=60, rounds=6)
    assert len(model.terms) == 60
    embedded = latent.embed(terms.vectors(docs, vocabulary), model)
    x, e = dense_matrix(embedded, model)
    _, size, right = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(model.strength[:8], size[:8], rtol=1e-3)
    assert np.allclose(e, x @ model.vectors, atol=1e-9)
    v = model.vectors
    assert np.allclose(v.T @ v, np.eye(20), atol=1e-8)
    greatest = v[np.abs(v).argmax(axis=0), np.arange(20)]
    assert (greatest > 0).all()
    want = right[0] * np.sign(right[0][np.abs(right[0]).argmax()])
    assert np.allclose(v[:, 0], want, atol=1e-3)


def test_enough_columns_keep_inner_products(spark):
    docs = corpus(spark, 40)
    vocabulary, model = latent.fit_documents(docs, rank=64)
    x, e = dense_matrix(latent.embed(terms.vectors(docs, vocabulary), model), model)
    assert np.allclose(e @ e.T, x @ x.T, atol=1e-9)


def topics(spark, seed=7):
    """Documents use half of their topic's words, questions the other half."""
    rng = random.Random(seed)
    words = [["t%dw%d" % (t, k) for k in range(12)] for t in range(15)]
    docs, asked = [], []
    for k in range(450):
        t = k % 15
        docs.append((k, " ".join(rng.sample(words[t], 6) + ["noise%d" % rng.randrange(400)] * 2)))
    for t in range(15):
        asked.append((t, " ".join(rng.sample(words[t], 2))))
    return (
        spark.createDataFrame(docs, "row_id long, page_content string"),
        spark.createDataFrame(asked, "query_id long, question string"),
    )


def test_mean_reciprocal_rank_against_term_weights(spark):
    docs, asked = topics(spark)
    vocabulary, model = latent.fit_documents(docs, rank=15)
    vectors = terms.vectors(docs, vocabulary)

    def quality(found):
        marked = found.withColumn("hit", F.col("row_id") % 15 == F.col("query_id"))
        rate = evaluation.summary(evaluation.per_question(marked.select("query_id", "rank", "hit"))).first().mrr
        share = marked.agg(F.avg(F.col("hit").cast("int"))).first()[0]
        return rate, share

    sparse = quality(nearest(question_vectors(asked, vocabulary), vectors, 30, "terms"))
    rows = latent.embed(vectors, model).select("row_id", "embedding")
    make = latent.vectoriser(vocabulary, model)
    dense = quality(nearest(make(asked.withColumn("page_content", F.col("question"))), rows, 30))
    assert dense[0] >= sparse[0] - 1e-9 and dense[0] == 1.0
    # Beyond the rows that share the question's words, those of the same topic are found.
    assert dense[1] > 0.95 >= sparse[1] - 0.05


def test_empty_corpus(spark):
    docs = corpus(spark).limit(0)
    vocabulary, model = latent.fit_documents(docs, rank=4)
    assert len(model.terms) == 0
    other = spark.createDataFrame([(1, "any words")], "row_id long, page_content string")
    assert latent.embed(terms.vectors(other, vocabulary), model).first().embedding == [0.0]


def test_collection_with_dense_vectors_cells_and_postings(spark, tmp_path):
    topical, _ = topics(spark)
    files = topical.select(
        F.concat(F.lit("/t/"), "row_id", F.lit(".md")).alias("path"), F.col("page_content").alias("content")
    )
    root = str(tmp_path / "store")
    rows = ingest(files)
    assert write_collection(
        rows, root, dense=15, cells=coarse.Cells(cells=15, per_cell=20), blocks=postings.Shape(shard=500)
    )
    stored = open_collection(spark, root, "default")
    asked = spark.createDataFrame(
        [("a", "t3w1 t3w2", None, 4), ("b", "t5w0", '{"eq": ["source", "/t/5.md"]}', 4)],
        "query_id string, question string, filter string, limit int",
    )
    plain = asked.drop("filter")
    bare = open_collection(spark, root, "default").__class__(
        **{**stored.__dict__, "postings": None}
    )
    order = lambda df: sorted((r.query_id, r["rank"], r.row_id, r.score) for r in df.collect())
    assert order(retrieve(stored, plain)) == order(retrieve(bare, plain))
    whole = order(retrieve(stored, asked, dense=True))
    assert order(retrieve(stored, asked, dense=True, probes=15)) == whole
    assert [r[1] for r in whole if r[0] == "b"] == [1]
    found = retrieve(stored, plain, dense=True, probes=2).join(stored.documents, "row_id")
    topic = F.regexp_extract("source", r"(\d+)\.md", 1).cast("int") % 15
    assert {(r[0], r[1]) for r in found.select("query_id", topic).distinct().collect()} == {("a", 3), ("b", 5)}
    assert ask(stored, plain, dense=True).count() == 2
    write_collection(rows, root)
    again = open_collection(spark, root, "default")
    assert again.latent is again.dense is again.cells is again.postings is None
    with pytest.raises(ValueError):
        retrieve(again, plain, dense=True)
