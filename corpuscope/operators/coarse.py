"""Dense top k over a stored coarse index: only the cells nearest to a question are read.

Centroids come from k-means rounds over a bounded sample: tasks assign their rows and send on
one sum per cell, the sums of a cell meet in a group, the driver holds the centroids only.
Every row is then stored under the cell of its nearest centroid, as a Parquet partition, in
files that are cut by ranges of cell and id, so that a cell with a third of all rows is many
files. A question probes its nearest cells; the scan is pruned to the partitions
some question probes. With all cells probed the result is that of ``nearest``.

Cases: rows without a vector, or of another length than most, are stored in a cell of
their own (-1), which every question probes, so nothing is lost; an empty table has no cells.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpuscope.config import EngineConfig
from corpuscope.functions.topk import score_batches
from corpuscope.operators.nearest import (
    _in_cells,
    _look_at,
    _question_columns,
    _ranked,
    _result_schema,
    _wanted_by_any,
)
from corpuscope.session import materialize

#: Cell of the rows that no centroid can be compared with.
ODD = -1
SEED = 17


@dataclass(frozen=True)
class Cells:
    """How a table is cut: ``cells`` centroids learnt from ``per_cell`` sampled rows each in
    ``rounds`` rounds. The sample is bounded by both, whatever the table's size."""

    cells: int = 256
    per_cell: int = 64
    rounds: int = 8
    #: Bytes of vectors per stored file, about.
    file_bytes: int = 128 << 20


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.sqrt((m**2).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _matrix(vectors: pa.Array, length: int) -> np.ndarray:
    flat = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, length)


def _closest(vectors: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the n nearest centroids, nearest first, of each unit vector."""
    near = vectors @ centroids.T
    n = min(n, near.shape[1])
    some = np.argpartition(-near, n - 1, axis=1)[:, :n]
    order = np.argsort(-np.take_along_axis(near, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1)


def usual_length(rows: DataFrame) -> int:
    """The most frequent length of a vector; 0 without vectors."""
    # One row per length.
    lengths = rows.where(F.size("embedding") > 0).groupBy(F.size("embedding").alias("n")).count()
    first = lengths.orderBy(F.desc("count"), "n").first()
    return first.n if first else 0


def train(rows: DataFrame, shape: Cells = Cells()) -> np.ndarray:
    """Unit centroids, at most ``shape.cells``, of the rows' directions."""
    length = usual_length(rows)
    if not length:
        return np.zeros((0, 0))
    order = F.xxhash64("row_id", F.lit(SEED))
    sample = materialize(
        rows.where(F.size("embedding") == length)
        .orderBy(order, "row_id")
        .limit(shape.cells * shape.per_cell)
        .select("row_id", F.col("embedding").cast("array<double>").alias("embedding"))
    )
    start = sample.orderBy(order, "row_id").limit(shape.cells).toArrow()
    centroids = _unit(_matrix(start["embedding"].combine_chunks(), length))
    for _ in range(shape.rounds):
        moved = _round(sample, centroids)
        done = np.allclose(moved, centroids, atol=1e-9)
        centroids = moved
        if done:
            break
    return centroids


def _round(sample: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids moved to the means of what is nearest to them; empty ones stay."""
    shared = sample.sparkSession.sparkContext.broadcast(centroids)
    length = centroids.shape[1]

    def summed(batches):
        held = shared.value
        sums, seen = np.zeros_like(held), np.zeros(len(held), dtype=np.int64)
        for batch in batches:
            unit = _unit(_matrix(batch.column(0), length))
            cell = _closest(unit, held, 1)[:, 0]
            np.add.at(sums, cell, unit)
            seen += np.bincount(cell, minlength=len(held))
        met = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met), pa.array(list(sums[met]), pa.list_(pa.float64()))], names=["cell", "sum"]
        )

    def added(table: pa.Table) -> pa.Table:
        total = _matrix(table["sum"].combine_chunks(), length).sum(axis=0)
        return pa.table({"cell": table["cell"][:1], "sum": pa.array([total], pa.list_(pa.float64()))})

    schema = "cell long, sum array<double>"
    # A group has a row per task.
    parts = sample.select("embedding").mapInArrow(summed, schema)
    found = parts.groupBy("cell").applyInArrow(added, schema).toArrow()
    shared.destroy()
    moved = centroids.copy()
    if found.num_rows:
        moved[found["cell"].to_numpy()] = _unit(_matrix(found["sum"].combine_chunks(), length))
    return moved


def with_cell(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds ``cell``, the number of the nearest centroid."""
    length = centroids.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast(centroids)
    names = rows.columns

    def run(batches):
        for batch in batches:
            vectors = batch.column("embedding")
            size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
            cell = np.full(batch.num_rows, ODD, dtype=np.int32)
            usual = np.flatnonzero((size == length) & (length > 0))
            if len(usual):
                unit = _unit(_matrix(vectors.take(pa.array(usual)), length))
                cell[usual] = _closest(unit, shared.value, 1)[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*names, "cell"])

    return rows.mapInArrow(run, _with(rows.schema, "cell", T.IntegerType()))


def store(rows: DataFrame, path: str, shape: Cells = Cells()) -> "CoarseIndex":
    """Writes ``{path}/rows`` by cell and ``{path}/centroids``; ``rows`` has row_id,
    embedding and any attributes."""
    spark = rows.sparkSession
    centroids = train(rows, shape)
    spark.createDataFrame(
        [(k, c.tolist()) for k, c in enumerate(centroids)], "cell int, centroid array<double>"
    ).coalesce(1).write.parquet(f"{path}/centroids")
    size = rows.agg(F.sum(8 * F.size("embedding") + 64)).first()[0] or 0
    files = max(1, -(-size // shape.file_bytes))
    with_cell(rows, centroids).repartitionByRange(files, "cell", F.xxhash64("row_id")).write.partitionBy(
        "cell"
    ).parquet(f"{path}/rows")
    return open_index(spark, path, rows.schema)


@dataclass(frozen=True)
class CoarseIndex:
    rows: DataFrame
    centroids: np.ndarray


def open_index(spark: SparkSession, path: str, schema=None) -> CoarseIndex:
    listed = spark.read.schema("cell int, centroid array<double>").parquet(f"{path}/centroids")
    found = listed.orderBy("cell").toArrow()
    n = found.num_rows
    length = len(found["centroid"][0]) if n else 0
    centroids = _matrix(found["centroid"].combine_chunks(), length) if n else np.zeros((0, 0))
    reader = spark.read if schema is None else spark.read.schema(_with(schema, "cell", T.IntegerType()))
    return CoarseIndex(reader.parquet(f"{path}/rows"), centroids)


def _probed(asked: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    """A row per question and cell it probes."""
    length = centroids.shape[1]
    names = asked.columns

    def run(batches):
        for batch in batches:
            size = pc.list_value_length(batch.column("embedding")).to_numpy(zero_copy_only=False)
            cells = [[ODD]] * batch.num_rows
            usual = np.flatnonzero((size == length) & (length > 0))
            if len(usual):
                unit = _unit(_matrix(batch.column("embedding").take(pa.array(usual)), length))
                for k, found in zip(usual, _closest(unit, centroids, probes)):
                    cells[k] = [ODD, *found.tolist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*names, "cells"]
            )

    found = asked.mapInArrow(run, _with(asked.schema, "cells", T.ArrayType(T.IntegerType())))
    return found.select(*names, F.explode("cells").alias("cell"))


def nearest_stored(
    index: CoarseIndex,
    questions: DataFrame,
    k: int,
    kind: str = "cosine",
    probes: int = 8,
    config: EngineConfig = EngineConfig(),
) -> DataFrame:
    """Best k rows, or as many as the question's limit, of the probed cells, scored exactly."""
    if kind == "terms":
        raise ValueError("a coarse index holds dense vectors")
    asked = _question_columns(questions, index.rows, kind)
    size, attributes, *_ = _look_at(asked, kind, index.rows)
    wanted = _wanted_by_any(asked, index.rows, attributes)
    asked = materialize(_probed(asked, index.centroids, probes))
    # At most one row per cell of the index.
    cells = sorted(r.cell for r in asked.select("cell").distinct().collect())
    rows = wanted.where(F.col("cell").isin(cells) if cells else F.lit(False))
    rows = rows.where(F.col("embedding").isNotNull())
    rows = rows.select("row_id", "embedding", "cell", *(a for a in attributes if a != "cell"))
    if size * (1 + probes) <= config.broadcast_bytes:
        candidates = _beside_cells(asked, rows, k, kind, config)
    else:
        candidates = _in_cells(asked, rows, k, kind, config)
    return _ranked(candidates, k)


def _beside_cells(
    asked: DataFrame, rows: DataFrame, k: int, kind: str, config: EngineConfig
) -> DataFrame:
    """Rows stay where they are; a run of rows of one cell meets that cell's questions."""
    schema = _result_schema(asked, rows)
    id_type = to_arrow_type(rows.schema["row_id"].dataType)
    shared = rows.sparkSession.sparkContext.broadcast(asked.toArrow().sort_by("cell"))

    def run(batches):
        table = shared.value
        by_cell = table["cell"].to_numpy()

        def parts():
            for batch in batches:
                cell = batch.column("cell").to_numpy()
                cuts = np.flatnonzero(np.diff(cell)) + 1
                for a, b in itertools.pairwise([0, *cuts.tolist(), len(cell)]):
                    yield int(cell[a]) if b > a else ODD, batch.slice(a, b - a)

        for cell, same in itertools.groupby(parts(), key=lambda p: p[0]):
            a, b = np.searchsorted(by_cell, [cell, cell + 1])
            if b > a:
                some = (part for _, part in same)
                found = score_batches(some, table.slice(a, b - a), kind, k, id_type)
                yield from found.to_batches()

    return rows.mapInArrow(run, schema)
