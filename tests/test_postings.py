import random

import pytest
from pyspark.sql import functions as F

from corpuscope.config import EngineConfig
from corpuscope.operators import postings, terms
from corpuscope.operators.nearest import nearest
from corpuscope.plans.ask import question_vectors


def corpus(spark, n=400, seed=2):
    """Short and long texts, equal ones, an empty one; a frequent word in most."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        size = rng.choice([1, 2, 3, 8, 40, 150])
        words = ["w%d" % int(rng.paretovariate(0.6)) for _ in range(size)]
        rows.append((k, " ".join(words + ["the"] * (k % 3))))
    rows += [(n + k, rows[3][1]) for k in range(30)] + [(n + 50, ""), (n + 51, "the")]
    return spark.createDataFrame(rows, "row_id long, page_content string")


def asked(spark, vocabulary, seed=5):
    rng = random.Random(seed)
    texts = [" ".join("w%d" % int(rng.paretovariate(0.6)) for _ in range(rng.randrange(1, 12))) for _ in range(40)]
    rows = [(k, t, [None, 2, 0, 60][k % 4]) for k, t in enumerate([*texts, "", "unheard of", "the the", "w1"])]
    questions = spark.createDataFrame(rows, "query_id long, question string, limit int")
    return question_vectors(questions, vocabulary)


def result(df):
    return sorted((r.query_id, r["rank"], r.row_id, r.score) for r in df.collect())


@pytest.mark.parametrize(
    "shape", [postings.Shape(), postings.Shape(shard=300, block=4, questions=7, file_blocks=50)]
)
def test_same_rows_as_the_scan_of_all_vectors(spark, tmp_path, shape):
    docs = corpus(spark)
    vocabulary = terms.fit(docs)
    vectors = terms.vectors(docs, vocabulary)
    blocks = postings.store(vectors, str(tmp_path / "p"), shape)
    questions = asked(spark, vocabulary)
    got = result(postings.nearest_posted(blocks, questions, 5, shape))
    assert got == result(nearest(questions, vectors, 5, "terms"))


def test_blocks_are_in_the_order_of_impact(spark, tmp_path):
    docs = corpus(spark)
    vectors = terms.vectors(docs, terms.fit(docs))
    blocks = postings.store(vectors, str(tmp_path / "p"), postings.Shape(shard=500, block=8))
    lists = {}
    for r in blocks.orderBy("term", "shard", "block").collect():
        assert r.greatest == r.weights[0] and r.n == len(r.rows) == len(r.weights) <= 8
        lists.setdefault((r.term, r.shard), []).extend(zip(r.weights, r.rows))
    for held in lists.values():
        assert held == sorted(held, key=lambda x: (-x[0], x[1]))
    stored = sorted((t, row, w) for (t, _), held in lists.items() for w, row in held)
    pairs = vectors.select("row_id", F.explode(F.arrays_zip("terms", "weights")).alias("p")).where("p.weights > 0")
    assert stored == sorted((r.p.terms, r.row_id, r.p.weights) for r in pairs.collect())


def test_few_blocks_are_read(spark, tmp_path):
    """Shards whose bound is below the floor, and blocks that cannot lift a row to it, stay unread."""
    rng = random.Random(4)
    vocabulary = ["v%d" % k for k in range(3000)]
    rows = [(k, " ".join(rng.choice(vocabulary) for _ in range(250 if k % 8 else 12))) for k in range(2000)]
    docs = spark.createDataFrame(rows, "row_id long, page_content string")
    fitted = terms.fit(docs)
    vectors = terms.vectors(docs, fitted)
    shape = postings.Shape(shard=20000, block=8)
    blocks = postings.store(vectors, str(tmp_path / "p"), shape)
    texts = [(k, rows[8 * k][1]) for k in range(20)]
    questions = question_vectors(spark.createDataFrame(texts, "query_id long, question string"), fitted)
    k = 1
    got = postings.nearest_posted(blocks, questions, k, shape)
    assert result(got) == result(nearest(questions, vectors, k, "terms"))
    words = questions.select("query_id", F.explode(F.arrays_zip("terms", "weights")).alias("t")).select(
        "query_id", F.col("t.terms").alias("term"), F.col("t.weights").alias("w")
    )
    own = postings.own_buckets(blocks, words)
    heads, bounds = postings.bound_pairs(own, words)
    best = bounds.groupBy("query_id").agg(F.max_by("shard", F.struct("bound", "shard")).alias("shard"))
    found = got.withColumn("limit", F.lit(None).cast("int"))
    later = postings.second_round(questions, bounds, best, found, k)
    assert later.count() < 0.5 * bounds.count()
    total = blocks.agg(F.sum("n")).first()[0]
    read = postings.read_blocks(own, later, words, heads).agg(F.sum("n")).first()[0] or 0
    assert read < 0.02 * total
    plan = own._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan


def test_empty_sides(spark, tmp_path):
    docs = corpus(spark, 20)
    vocabulary = terms.fit(docs)
    none = terms.vectors(docs.limit(0), vocabulary)
    blocks = postings.store(none, str(tmp_path / "e"))
    assert postings.nearest_posted(blocks, asked(spark, vocabulary), 5).count() == 0
    blocks = postings.store(terms.vectors(docs, vocabulary), str(tmp_path / "p"))
    assert postings.nearest_posted(blocks, asked(spark, vocabulary).limit(0), 5).count() == 0


def test_postings_stay_where_they_are_cut(spark, tmp_path):
    """All blocks of a shard are written by the task that made them, not shuffled and sorted anew."""
    docs = corpus(spark)
    shape = postings.Shape(shard=300, block=4, file_blocks=50)
    blocks = postings.store(terms.vectors(docs, terms.fit(docs)), str(tmp_path / "p"), shape)
    part = F.regexp_extract(F.input_file_name(), r"/part-(\d+)", 1)
    places = blocks.select("shard", part.alias("part")).distinct().collect()
    assert len({r.part for r in places}) > 1
    assert len({r.shard for r in places}) == len(places)


@pytest.mark.parametrize("most", [10**6, 120, 0])
def test_reading_shuffles_only_needed_blocks(spark, tmp_path, monkeypatch, most):
    """Also where the planner broadcasts nothing by itself, and where there is too much to broadcast."""
    monkeypatch.setattr(postings, "BROADCAST_ROWS", most, raising=False)
    docs, shape = corpus(spark), postings.Shape(shard=300, block=4, questions=7)
    vocabulary = terms.fit(docs)
    vectors, questions = terms.vectors(docs, vocabulary), asked(spark, vocabulary)
    expected = result(nearest(questions, vectors, 5, "terms"))
    blocks = postings.store(vectors, str(tmp_path / "p"), shape)
    plans, read = [], postings.read_blocks
    monkeypatch.setattr(postings, "read_blocks", lambda *a: plans.append(read(*a)) or plans[-1])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert result(postings.nearest_posted(blocks, questions, 5, shape)) == expected
        shown = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(shown) == 2
    if most == 10**6:
        assert not any("hashpartitioning" in plan for plan in shown)
    if most == 120:
        assert any("greatest" in plan and "rough" in plan for plan in shown)


@pytest.mark.parametrize("most", [10**6, 30, 0])
def test_vectors_dealt_by_row(spark, most):
    """Equal rows, whatever is broadcast; the rows of an id are in one partition."""
    docs = corpus(spark).union(corpus(spark).limit(40)).repartition(7)
    vocabulary, config = terms.fit(docs), EngineConfig(broadcast_terms=most)
    plain = lambda df: sorted((r.row_id, sorted(zip(r.terms, [round(w, 12) for w in r.weights]))) for r in df.collect())
    unique = docs.dropDuplicates(["row_id"])
    dealt = terms.vectors(unique, vocabulary, config=config, tasks=3)
    assert plain(dealt) == plain(terms.vectors(unique, vocabulary))
    assert plain(dealt) == plain(terms.vectors(unique, vocabulary, config=config))
    places = terms.vectors(docs, vocabulary, config=config, tasks=3).select("row_id", F.spark_partition_id().alias("p"))
    assert places.distinct().groupBy("row_id").count().where("count > 1").isEmpty()
    assert places.agg(F.max("p")).first()[0] <= 2
