"""Dense vectors of a corpus's own, by a randomised range finder over its term vectors.

The vocabulary is bounded: the ``most_terms`` terms with the highest document frequencies (ties by
term). Over it the corpus is a sparse matrix X of documents and terms. Each round is one
pass over the stored term vectors: a task multiplies its rows with a dense block of
``rank + EXTRA`` columns and back, ``X'(X B)``, and sends on a row of sums per term it has
met; the sums of a term meet in one partition, as many rows as there are tasks. The driver
orthonormalises the block, which the vocabulary bounds. A last pass gives the small
matrix (XQ)'(XQ), whose eigenvectors turn the block into singular vectors. The sign of each is
fixed: its entry of greatest size is positive, the first of equals.

With at least as many columns as X has independent rows, inner products of the new vectors
are those of the term vectors.

Cases: documents without terms of the vocabulary get the zero vector; an empty corpus gives a
model without terms, whose vectors are all zero.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscope.operators import terms
from corpuscope.session import materialize

#: Columns besides the wanted ones while the range is looked for.
EXTRA = 16
#: Products held at once.
HELD = 2_000_000


@dataclass(frozen=True)
class Latent:
    """``vectors[k]`` belongs to ``terms[k]``; ``strength`` has the singular values."""

    terms: pa.Array
    vectors: np.ndarray
    strength: np.ndarray


def _entries(batch: pa.RecordBatch, known: pa.Array):
    """(row, term number, weight) of the known terms of a batch, in row order."""
    lists = batch.column("terms")
    row = pc.list_parent_indices(lists).to_numpy()
    code = pc.fill_null(pc.index_in(pc.list_flatten(lists), value_set=known), -1).to_numpy()
    weight = pc.list_flatten(batch.column("weights")).to_numpy()
    kept = code >= 0
    return row[kept], code[kept], weight[kept]


def _times(row, code, weight, block: np.ndarray, n: int) -> np.ndarray:
    """Rows of X times a block."""
    out = np.zeros((n, block.shape[1]))
    step = max(1, HELD // max(1, block.shape[1]))
    for a in range(0, len(row), step):
        part = slice(a, a + step)
        starts = np.flatnonzero(np.diff(row[part], prepend=-1))
        products = weight[part, None] * block[code[part]]
        out[row[part][starts]] += np.add.reduceat(products, starts, axis=0)
    return out


def _back(row, code, weight, left: np.ndarray, sums: np.ndarray) -> None:
    """Adds X' times rows to the sums per term."""
    order = np.argsort(code, kind="stable")
    row, code, weight = row[order], code[order], weight[order]
    step = max(1, HELD // max(1, left.shape[1]))
    for a in range(0, len(row), step):
        part = slice(a, a + step)
        starts = np.flatnonzero(np.diff(code[part], prepend=-1))
        products = weight[part, None] * left[row[part]]
        sums[code[part][starts]] += np.add.reduceat(products, starts, axis=0)


_SUMS = "number int, sums array<double>"


def _sum_batch(number, sums) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(number, pa.int32()), pa.array(list(sums), pa.list_(pa.float64()))],
        names=["number", "sums"],
    )


def _added(parts: DataFrame, n: int, width: int) -> np.ndarray:
    """Sums per number over all tasks; the driver gets at most n rows."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = pc.list_flatten(batch.column(1)).to_numpy().reshape(-1, width)
            for number, row in zip(batch.column(0).to_pylist(), rows):
                held[number] = held[number] + row if number in held else row.copy()
        if held:
            yield _sum_batch(list(held), held.values())

    out = np.zeros((n, width))
    found = parts.repartition("number").mapInArrow(run, _SUMS).toArrow()
    if found.num_rows:
        values = pc.list_flatten(found["sums"].combine_chunks()).to_numpy()
        out[found["number"].to_numpy()] = values.reshape(-1, width)
    return out


def _pass(vectors: DataFrame, known: pa.Array, block: np.ndarray, gram: bool) -> np.ndarray:
    """X'(X block), or with ``gram`` (X block)'(X block), over all documents."""
    shared = vectors.sparkSession.sparkContext.broadcast((known, block))
    width = block.shape[1]
    n = width if gram else len(known)

    def run(batches):
        known, block = shared.value
        sums = np.zeros((n, width))
        for batch in batches:
            row, code, weight = _entries(batch, known)
            left = _times(row, code, weight, block, batch.num_rows)
            if gram:
                sums += left.T @ left
            else:
                _back(row, code, weight, left, sums)
        met = np.flatnonzero(np.abs(sums).sum(axis=1))
        for a in range(0, len(met), 10_000):
            yield _sum_batch(met[a : a + 10_000], sums[met[a : a + 10_000]])

    found = _added(vectors.select("terms", "weights").mapInArrow(run, _SUMS), n, width)
    shared.destroy()
    return found


def _orthonormal(block: np.ndarray) -> np.ndarray:
    """Columns that span the same space, without those that add nothing."""
    left, size, _ = np.linalg.svd(block, full_matrices=False)
    return left[:, size > size.max(initial=0.0) * 1e-10]


def fit(
    vectors: DataFrame,
    vocabulary: terms.Vocabulary,
    rank: int = 128,
    most_terms: int = 100_000,
    rounds: int = 2,
    seed: int = 17,
) -> Latent:
    """The model of term vectors ``terms, weights``, which are read ``rounds + 1`` times."""
    chosen = vocabulary.table.orderBy(F.desc("df"), "term").limit(most_terms).select("term")
    known = chosen.toArrow()["term"].combine_chunks()
    block = np.random.default_rng(seed).standard_normal((len(known), rank + EXTRA))
    for _ in range(rounds):
        if not block.size:
            break
        block = _orthonormal(_pass(vectors, known, block, gram=False))
    if not block.size:
        return Latent(known, np.zeros((len(known), 0)), np.zeros(0))
    size, turn = np.linalg.eigh(_pass(vectors, known, block, gram=True))
    order = np.argsort(-size, kind="stable")[:rank]
    order = order[size[order] > size.max() * 1e-12]
    found = block @ turn[:, order]
    greatest = found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])]
    return Latent(known, found * np.where(greatest < 0, -1.0, 1.0), np.sqrt(size[order]))


def embed(vectors: DataFrame, model: Latent) -> DataFrame:
    """Adds ``embedding`` (doubles) to rows with ``terms, weights``."""
    shared = vectors.sparkSession.sparkContext.broadcast((model.terms, model.vectors))
    names = vectors.columns
    width = max(1, model.vectors.shape[1])

    def run(batches):
        known, block = shared.value
        if not block.shape[1]:
            block = np.zeros((len(known), 1))
        for batch in batches:
            out = _times(*_entries(batch, known), block, batch.num_rows)
            offsets = pa.array(np.arange(batch.num_rows + 1) * width, pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*names, "embedding"])

    field = T.StructField("embedding", T.ArrayType(T.DoubleType()))
    return vectors.mapInArrow(run, T.StructType([*vectors.schema.fields, field]))


def vectoriser(vocabulary: terms.Vocabulary, model: Latent):
    """Function that adds ``embedding`` to rows with ``row_id`` or ``query_id`` and
    ``page_content``; other columns are kept."""

    def run(docs: DataFrame) -> DataFrame:
        key = "row_id" if "row_id" in docs.columns else "query_id"
        named = docs.withColumnRenamed(key, "row_id")
        kept = tuple(c for c in named.columns if c != "row_id")
        dense = embed(terms.vectors(named, vocabulary, keep=kept), model)
        rounded = F.col("embedding").cast("array<float>").alias("embedding")
        return dense.select(F.col("row_id").alias(key), *kept, rounded)

    return run


def store(spark: SparkSession, model: Latent, path: str) -> None:
    listed = [(t, v.tolist()) for t, v in zip(model.terms.to_pylist(), model.vectors)]
    schema = "term string, vector array<double>"
    spark.createDataFrame(listed, schema).coalesce(1).write.parquet(f"{path}/terms")
    strength = spark.createDataFrame([(model.strength.tolist(),)], "strength array<double>")
    strength.coalesce(1).write.parquet(f"{path}/strength")


def load(spark: SparkSession, path: str) -> Latent:
    found = spark.read.schema("term string, vector array<double>").parquet(f"{path}/terms").toArrow()
    strength = np.array(spark.read.parquet(f"{path}/strength").first().strength)
    values = pc.list_flatten(found["vector"].combine_chunks()).to_numpy()
    return Latent(
        found["term"].combine_chunks(), values.reshape(found.num_rows, len(strength)), strength
    )


def fit_documents(docs: DataFrame, rank: int = 128, **options) -> tuple[terms.Vocabulary, Latent]:
    """Vocabulary and model of ``row_id, page_content``."""
    vocabulary = terms.fit(docs)
    vectors = materialize(terms.vectors(docs, vocabulary))
    return vocabulary, fit(vectors, vocabulary, rank, **options)
