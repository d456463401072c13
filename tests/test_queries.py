"""Registered queries against their SQL, on given and on skewed tables."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from check import TABLES, normal

GIVEN = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(GIVEN), reason="tables are not here")


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the line items in one order, of the orders at one customer, of
    the customers in one nation; a third of documents and vectors are copies."""
    root = str(tmp_path_factory.mktemp("skewed"))
    third = lambda c: F.pmod(F.xxhash64(*c), F.lit(3)) == 0

    def replace(df, column, value, *key):
        return df.withColumn(column, F.when(third(key), F.lit(value)).otherwise(F.col(column)))

    for name in TABLES:
        df = spark.read.parquet(f"{GIVEN}/{name}.parquet")
        if name == "lineitem":
            df = replace(df, "l_orderkey", 3, "l_partkey", "l_suppkey")
        elif name == "orders":
            df = replace(df, "o_custkey", 7, "o_orderkey")
        elif name == "customer":
            df = replace(df, "c_nationkey", 4, "c_custkey")
        elif name == "documents":
            text = df.orderBy("doc_id").first().text
            df = replace(replace(df, "text", text, "doc_id"), "source", "src1", "doc_id")
        elif name == "embeddings":
            vector = df.first().embedding
            copy = F.array(*[F.lit(v) for v in vector]).cast("array<float>")
            df = df.withColumn(
                "embedding", F.when(third(["vec_id"]), copy).otherwise(F.col("embedding"))
            ).withColumn("label", F.when(third(["vec_id"]), 1).otherwise(F.col("label")))
        df.repartition(3).write.parquet(f"{root}/{name}.parquet")
    return root


def compare(spark, sf_dir, name):
    db = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    got = normal(entry.queries()[name](spark, sf_dir).toPandas())
    want = normal(db.sql(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    assert got.map(repr).equals(want.map(repr))


def test_every_expected_result_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 6000 and "page_content" in df.columns


@pytest.mark.parametrize("name", ["ext_dispatch_counts", "dictionary_column_docs", "python_functions"])
def test_given_tables(spark, name):
    compare(spark, GIVEN, name)


@pytest.mark.parametrize(
    "name",
    [
        "dag_task_docs", "dag_edges", "dag_fault_prefix", "file_warnings", "dictionary_column_docs",
        "union_hybrid", "tfidf_weights", "text_topk", "answer_context", "vector_topk_cells",
        "vector_topk_filtered", "retrieval_eval",
    ],
)
def test_skewed_tables(spark, skewed, name):
    compare(spark, skewed, name)
