import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuscope.config import EngineConfig
from corpuscope.operators import coarse
from corpuscope.operators.nearest import nearest, recall


def clustered(spark, n=1500, groups=12, seed=1, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, 16))
    label = rng.integers(groups, size=n)
    points = centres[label] + 0.15 * rng.standard_normal((n, 16))
    points[:copies] = points[0]
    rows = [(k, int(label[k]), p.tolist()) for k, p in enumerate(points)]
    return spark.createDataFrame(rows, "row_id long, label int, embedding array<float>")


def asked(rows, step=20):
    return rows.where(F.col("row_id") % step == 0).withColumnRenamed("row_id", "query_id")


def result(df):
    return sorted((r.query_id, r["rank"], r.row_id, r.score) for r in df.collect())


@pytest.mark.parametrize("kind", ["cosine", "l2"])
@pytest.mark.parametrize("config", [EngineConfig(), EngineConfig(broadcast_bytes=0, cell_rows=100)])
def test_all_cells_are_the_exact_result(spark, tmp_path, kind, config):
    rows = clustered(spark, 400, copies=140)
    odd = spark.createDataFrame(
        [(9000, 1, None), (9001, 2, [1.0, 2.0]), (9002, 3, []), (9003, 4, [0.0] * 16), (9004, 4, [2.0, 1.0])],
        rows.schema,
    )
    rows = rows.union(odd)
    index = coarse.store(rows, str(tmp_path / "i"), coarse.Cells(cells=12, per_cell=10))
    same = (F.col("label") + 1).cast("string")
    questions = asked(rows, 7).withColumns(
        {
            "filter": F.when(F.col("query_id") % 2 == 0, F.concat(F.lit('{"lte": ["label", '), same, F.lit("]}"))),
            "limit": (F.col("query_id") % 9).cast("int"),
        }
    ).union(odd.select("row_id", "label", "embedding", F.lit(None), F.lit(2)))
    got = coarse.nearest_stored(index, questions, 5, kind, 12, config)
    assert result(got) == result(nearest(questions, rows, 5, kind))


def test_few_cells_find_nearly_all_and_only_they_are_read(spark, tmp_path):
    rows = clustered(spark)
    index = coarse.store(rows, str(tmp_path / "i"), coarse.Cells(cells=24))
    questions = asked(rows)
    exact = nearest(questions, rows, 5)
    found = recall(coarse.nearest_stored(index, questions, 5, probes=4), exact).first()
    assert found.recall >= 0.97
    one = questions.where("query_id = 40")
    got = coarse.nearest_stored(index, one, 5, probes=2)
    cells = coarse._probed(coarse._question_columns(one, rows, "cosine"), index.centroids, 2)
    read = index.rows.where(F.col("cell").isin([r.cell for r in cells.collect()]))
    assert 5 < read.count() < 0.3 * 1500
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [cell" in plan
    files = {r[0] for r in read.select(F.input_file_name()).distinct().collect()}
    every = {r[0] for r in index.rows.select(F.input_file_name()).distinct().collect()}
    assert len(files) <= 3 < len(every)


def test_a_hot_cell_is_many_files(spark, tmp_path):
    rows = clustered(spark, 900, copies=300)
    shape = coarse.Cells(cells=8, file_bytes=9000)
    index = coarse.store(rows, str(tmp_path / "i"), shape)
    named = index.rows.select("cell", F.input_file_name().alias("file"))
    hot = named.groupBy("cell").agg(F.count("*").alias("n"), F.countDistinct("file").alias("f"))
    top = hot.orderBy(F.desc("n")).first()
    assert top.n >= 300 and top.f > 3
    assert index.rows.count() == 900


def test_opened_again_and_empty(spark, tmp_path):
    rows = clustered(spark, 100)
    coarse.store(rows, str(tmp_path / "i"), coarse.Cells(cells=4))
    again = coarse.open_index(spark, str(tmp_path / "i"))
    assert again.centroids.shape == (4, 16) and again.rows.count() == 100
    none = coarse.store(rows.limit(0), str(tmp_path / "e"))
    assert coarse.nearest_stored(none, asked(rows), 5).count() == 0
    assert coarse.nearest_stored(again, asked(rows).limit(0), 5).count() == 0


def test_filters_of_all_questions_reach_the_scan(spark, tmp_path):
    rows = clustered(spark, 300)
    rows.repartitionByRange(4, "label").write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    label = F.col("label").cast("string")
    spec = F.concat(F.lit('{"or": [{"eq": ["label", '), label, F.lit(']}, {"in": ["label", [1, 2]]}]}'))
    questions = asked(rows).where("label < 4").withColumn("filter", spec)
    got = nearest(questions, stored, 4)
    assert "PushedFilters: [Or" in got._jdf.queryExecution().toString().replace("IsNotNull(embedding), ", "")
    some = questions.withColumn("filter", F.when(F.col("query_id") > 40, F.col("filter")))
    assert result(nearest(some, stored, 4)) == result(nearest(some, rows, 4))
    assert result(got) == [r for r in result(nearest(questions, rows, 4))]
