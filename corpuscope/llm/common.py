"""What the corpus operators share: stored steps, row keys, connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpuscope.session import materialize_for_join, scratch_path

#: A null id takes part in joins under this value, so it meets only other null ids.
NULL_ID = -(2**63)
#: Rows whose texts a task holds as Python strings at once.
ROWS = 2000


def in_tasks(df: DataFrame, run, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` over batches of at most ROWS rows that gives memory back when a task ends:
    workers are used again by later stages, which need the room."""

    def task(batches):
        yield from run(
            batch.slice(at, ROWS) for batch in batches for at in range(0, batch.num_rows, ROWS)
        )
        give_back()

    return df.mapInArrow(task, schema)


def give_back() -> None:
    """Free memory of Python, Arrow and, where there is one to ask, the C library."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, lineage cut,
    readable after the executors that wrote it are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc, text) without nulls; other columns, whatever their names, stay behind."""
    return docs.select(id_key(id_column).alias("doc"), text_of(text_column).alias("text"))


def marked(docs: DataFrame) -> DataFrame:
    """(doc, text, mark, twin): mark and twin, 128 bits, name a row; equal rows share them."""
    return texts(docs).select("doc", "text", *marks("doc", "text"))


def marks(doc: str, text: str) -> list[Column]:
    return [F.xxhash64(doc, text).alias("mark"), F.xxhash64(text, doc).alias("twin")]


def id_back(column: str = "doc", name: str = "doc_id") -> Column:
    """The id a key stands for."""
    return F.nullif(F.col(column), F.lit(NULL_ID)).alias(name)


def without(docs: DataFrame, gone: DataFrame, twice: DataFrame, rows: int) -> DataFrame:
    """The rows of ``docs``, all columns, whose (mark, twin) is not in ``gone``; of those in
    ``twice`` one each. Up to ``rows`` of either list are broadcast."""
    columns = [docs[f"`{c}`"] for c in docs.columns]
    named = docs.select(
        F.struct(*columns).alias("all"), id_key("doc_id").alias("doc"), text_of("text").alias("text")
    ).select("all", *marks("doc", "text"))
    left = named.join(materialize_for_join(gone, rows), ["mark", "twin"], "left_anti")
    twice = materialize_for_join(twice, rows)
    if not twice.isEmpty():
        once = left.join(twice, ["mark", "twin"], "left_semi").dropDuplicates(["mark", "twin"])
        left = left.join(twice, ["mark", "twin"], "left_anti").unionByName(once)
    return left.select("all.*")


def slices(sizes, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose sizes add up to ``most`` at most, or one row."""
    first, total = 0, 0
    for row, size in enumerate(sizes):
        if total and total + size > most:
            yield first, row
            first, total = row, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): root is the smallest node that edges ``(a, b)`` lead to.

    Large-star and small-star rounds over tables in the shared folder. A round
    groups with partial aggregation and joins the stored minima back, so a node with a
    third of all edges is split by adaptive execution. Nodes without edges are
    not returned.
    """
    edges = stored(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where("hi <> lo")
        .distinct(),
        name,
    )
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if state == seen or state[0] == 0:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                edges.select("lo", "lo").distinct()
            )
        seen = state
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            edges.select("lo", "hi")
        )
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")), name)
        large = stored(
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
            .distinct(),
            name,
        )
        roots = stored(large.groupBy("hi").agg(F.min("lo").alias("m")), name)
        small = (
            large.join(roots, "hi")
            .where("lo <> m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(roots.select("hi", F.col("m").alias("lo")))
            .distinct()
        )
        edges = stored(small, name)
