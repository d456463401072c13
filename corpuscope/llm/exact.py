"""Exact duplicates: a tree of merges over runs of digests, in DataFrame operations only.

Each input partition is a run of (digest, octets, check) with the smallest row of each.
A round merges the runs of FAN_IN neighbouring partitions into one: the aggregate sorts
what a task holds, exchanges it by key and merges the sorted parts, and keeps the smallest
row. The last round leaves one run. A key a third of all rows have is one row per run
before anything is exchanged. Rows count as equal only if the SHA-256 digest, the length
and a second hash agree, so no merge trusts one digest alone.

Cases: null text is empty; of equal texts the row with the smallest id stays, rows without
an id come last; of repeated rows one stays; an empty table gives no rows; columns besides
id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import NULL_ID, id_back, id_key, stored, text_of
from corpuscope.session import materialize_for_join

FAN_IN = 8
BROADCAST_ROWS = 500_000
WHITE = r"[\x20\x09-\x0D]+"
KEY = ("digest", "octets", "check")


def keyed(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> list:
    """Columns doc, digest, octets, check of a table of texts."""
    text = F.regexp_replace(text_of(text_column), WHITE, " ")
    return [
        id_key(id_column).alias("doc"),
        F.sha2(text, 256).alias("digest"),
        F.octet_length(text).alias("octets"),
        F.xxhash64(text).alias("check"),
    ]


def merge_runs(rows: DataFrame) -> DataFrame:
    """(digest, octets, check, least, n): one row per key, from runs of rows."""
    run = rows.select(
        *KEY,
        "run",
        F.struct((F.col("doc") == NULL_ID).alias("missing"), "doc", "row").alias("least"),
        F.lit(1).cast("long").alias("n"),
    )
    left = (rows.agg(F.max("run")).first()[0] or 0) + 1
    while True:
        run = (
            run.withColumn("run", F.floor(F.col("run") / FAN_IN).cast("int"))
            .groupBy("run", *KEY)
            .agg(F.min("least").alias("least"), F.sum("n").alias("n"))
        )
        left = -(-left // FAN_IN)
        if left == 1:
            return run.drop("run")


def resolve(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc, digest, octets, check, keep (id key of the row that stays), n, kept."""
    rows = stored(
        docs.select(
            *keyed(docs, id_column, text_column),
            F.spark_partition_id().alias("run"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "exact-digests",
    )
    return rows.join(merge_runs(rows), list(KEY)).select(
        "doc",
        *KEY,
        F.col("least.doc").alias("keep"),
        "n",
        (F.col("least.row") == F.col("row")).alias("kept"),
    )


def report(docs: DataFrame) -> DataFrame:
    return resolve(docs).select(
        id_back(),
        id_back("keep", "keep_id"),
        F.col("n").alias("group_size"),
        "kept",
        F.col("digest").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay."""
    rows = stored(
        resolve(docs)
        .where("n > 1")
        .groupBy("doc", *KEY)
        .agg(F.max("kept").alias("stays"), F.count("*").alias("copies")),
        "exact-groups",
    )
    plain = docs.columns
    key = [c.alias(f"_{n}") for n, c in zip(("doc", *KEY), keyed(docs))]
    marked = docs.select(F.struct(*(docs[f"`{c}`"] for c in plain)).alias("_all"), *key)
    same = lambda other: [marked[f"_{n}"] == other[n] for n in ("doc", *KEY)]
    gone = materialize_for_join(rows.where("not stays"), BROADCAST_ROWS)
    left = marked.join(gone, same(gone), "left_anti")
    twice = materialize_for_join(rows.where("stays and copies > 1"), BROADCAST_ROWS)
    if not twice.isEmpty():
        once = left.join(twice, same(twice), "left_semi").dropDuplicates(
            [f"_{n}" for n in ("doc", *KEY)]
        )
        left = left.join(twice, same(twice), "left_anti").unionByName(once)
    return left.select("_all.*")
