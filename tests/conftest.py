import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        # No call-site capture per expression: plans here have thousands.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ingest_texts(spark):
    """Documents and warnings of ``{path: text}`` as lists of rows in file order."""
    from corpuscope.plans.ingest import ingest

    def run(texts, **options):
        files = spark.createDataFrame(list(texts.items()), "path string, content string")
        rows = ingest(files, **options).orderBy("source", "ordinal").collect()
        return (
            [r for r in rows if r.kind != "warning"],
            [r for r in rows if r.kind == "warning"],
        )

    return run
