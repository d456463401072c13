"""Best rows per question over stored postings, in the order of their impact.

Rows are dealt by ``row_id`` to tasks, and there into shards of bounded size, rows of like weights
together (a layer is the power of two below a row's greatest weight), so that the greatest
weight of a term in a shard says much about the shard. In a shard a term's postings are sorted by
weight and cut into blocks that carry their greatest weight. Each task writes its blocks by bucket:
of the postings nothing but the stored blocks is ever on disk.

Questions read only the blocks of their own terms, in two rounds, and exactly:

1. The greatest weights bound what a row of a shard can score for a question. The shard of
   the best bound is read, and gives the question a floor: its k-th score so far.
2. Of the other shards only those whose bound reaches the floor are read, and there only
   blocks with ``w * greatest + bound of the question's other terms`` at or above it.
   All blocks of a row that reaches the floor pass this test, so its score is whole; a row
   that lacks a block is below the floor and is left out.

Nothing here pairs questions with rows: tables hold pairs of question and shard, a task
scores the blocks of one shard for a cut of the questions with numpy.

Cases: terms of weight 0 are not stored; empty rows are in no posting; questions without terms
get nothing; equal scores are ordered by row_id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpuscope.config import EngineConfig
from corpuscope.functions.topk import DECIMALS
from corpuscope.operators.nearest import _question_columns, _ranked, _result_schema
from corpuscope.session import materialize, materialize_for_join

BUCKETS = 64
#: Scores are compared after rounding, so a bound this little below the floor still counts.
SLACK = 2 * 10.0**-DECIMALS
LAYERS = 16
BROADCAST_ROWS = EngineConfig.broadcast_rows
#: Shards' worth of postings that a writing task takes, about.
SHARDS = 4


@dataclass(frozen=True)
class Shape:
    #: Postings per shard and per block, about; questions scored in one task.
    shard: int = 1_000_000
    block: int = 128
    questions: int = 2_000
    #: No longer used: a task writes the blocks of its own shards.
    file_blocks: int = 200_000


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def tasks_for(n_postings: int, shape: Shape = Shape()) -> int:
    """Tasks that write so many postings; each holds its share in memory."""
    return max(1, -(-n_postings // (shape.shard * SHARDS)))


def _shards(deal: np.ndarray, greatest: np.ndarray, sizes: np.ndarray, shape: Shape) -> np.ndarray:
    """Number of each row's shard within its task, -1 for rows without weights; shards have
    about ``shape.shard`` postings of one layer, and rows dealt alike share the layer's shard."""
    shard = np.full(len(deal), -1, dtype=np.int64)
    some = np.flatnonzero(greatest > 0)
    layer = np.clip(np.floor(-np.log2(greatest[some])), 0, LAYERS - 1).astype(np.int64)
    for at in np.unique(layer):
        rows = some[layer == at]
        within = deal[rows] % -(-int(sizes[rows].sum()) // shape.shard)
        shard[rows] = (at << 40) + within
    return shard


def store(vectors: DataFrame, path: str, shape: Shape = Shape(), gathered: bool = False) -> DataFrame:
    """Writes blocks of ``row_id, terms, weights`` to ``path``; the stored blocks.

    Rows are dealt by ``row_id`` to tasks, which make their own shards and write their blocks
    where they are: no posting is shuffled or sorted again. ``gathered`` vectors are dealt already
    (``terms.vectors`` with ``tasks``), and read once.
    """
    id_type = vectors.schema["row_id"].dataType
    schema = T.StructType(
        [
            T.StructField("shard", T.LongType()),
            T.StructField("term", T.StringType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("greatest", T.DoubleType()),
            T.StructField("n", T.IntegerType()),
            T.StructField("rows", T.ArrayType(id_type)),
            T.StructField("weights", T.ArrayType(T.DoubleType())),
        ]
    )
    length = shape.block

    def cut(shard: int, ids: pa.Array, owner, code, weight, known: pa.Array) -> pa.RecordBatch:
        place = np.empty(len(ids), dtype=np.int64)
        place[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        order = np.lexsort((place[owner], -weight, code))
        order = order[weight[order] > 0]
        code, weight, owner = code[order], weight[order], owner[order]
        at = np.arange(len(code)) - np.searchsorted(code, code)
        starts = np.flatnonzero(at % length == 0)
        offsets = pa.array(np.append(starts, len(code)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(starts), shard, dtype=np.int64)),
                known.take(pa.array(code[starts])),
                pa.array((at[starts] // length).astype(np.int32)),
                pa.array(weight[starts]),
                pa.array(np.diff(np.append(starts, len(code))).astype(np.int32)),
                pa.ListArray.from_arrays(offsets, ids.take(pa.array(owner))),
                pa.ListArray.from_arrays(offsets, pa.array(weight)),
            ],
            names=schema.names,
        )

    def run(batches):
        task = TaskContext.get().partitionId() << 16
        ids, deal, greatest, sizes, terms, weights = [], [], [], [], [], []
        for batch in batches:
            size = pc.fill_null(pc.list_value_length(batch.column("terms")), 0).to_numpy()
            weight = pc.list_flatten(batch.column("weights")).to_numpy()
            most, some = np.zeros(len(size)), size > 0
            if len(weight):
                most[some] = np.maximum.reduceat(weight, (np.cumsum(size) - size)[some])
            ids.append(batch.column("row_id"))
            deal.append(batch.column("deal").to_numpy())
            greatest.append(most)
            sizes.append(size)
            terms.append(pc.list_flatten(batch.column("terms")).dictionary_encode())
            weights.append(weight)
        if not ids:
            return
        coded = pa.chunked_array(terms).unify_dictionaries()
        known = coded.chunk(0).dictionary
        by_text = pc.sort_indices(known)
        number_of = np.empty(len(known), np.int32)
        number_of[by_text.to_numpy()] = np.arange(len(known))
        known = known.take(by_text)
        ids, sizes = pa.chunked_array(ids).combine_chunks(), np.concatenate(sizes)
        code = number_of[np.concatenate([c.indices.to_numpy() for c in coded.chunks])]
        weight = np.concatenate(weights)
        del terms, weights, coded
        begin = np.cumsum(sizes) - sizes
        shard = _shards(np.concatenate(deal), np.concatenate(greatest), sizes, shape)
        for number in np.unique(shard[shard >= 0]):
            rows = np.flatnonzero(shard == number)
            owner = np.repeat(np.arange(len(rows)), sizes[rows])
            at = np.arange(len(owner)) + (begin[rows] - np.cumsum(sizes[rows]) + sizes[rows])[owner]
            yield cut(int(number) + task, ids.take(pa.array(rows)), owner, code[at], weight[at], known)

    if not gathered:
        n = vectors.agg(F.sum(F.size("terms"))).first()[0] or 0
        tasks = tasks_for(n, shape)
        vectors = vectors.repartition(tasks, "row_id").coalesce(tasks)
    rows = vectors.select("row_id", F.xxhash64("row_id").alias("deal"), "terms", "weights")
    blocks = rows.mapInArrow(run, schema).withColumn("bucket", _bucket(F.col("term")))
    # In a shard, blocks are in the order of terms already.
    blocks.sortWithinPartitions("bucket").write.partitionBy("bucket").parquet(path, compression="zstd")
    return open_blocks(vectors.sparkSession, path, id_type)


def open_blocks(spark: SparkSession, path: str, id_type: T.DataType) -> DataFrame:
    ids = id_type.simpleString()
    return spark.read.schema(
        "shard long, term string, block int, greatest double, n int,"
        f" rows array<{ids}>, weights array<double>, bucket int"
    ).parquet(path)


def own_buckets(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """Blocks of the questions' terms, in their buckets; there are BUCKETS at most."""
    asked = materialize_for_join(words.select("term").distinct(), BROADCAST_ROWS)
    buckets = sorted(r[0] for r in asked.select(_bucket(F.col("term"))).distinct().collect())
    own = blocks.where(F.col("bucket").isin(buckets) if buckets else F.lit(False)).drop("bucket")
    return own.join(asked, "term", "left_semi") if asked.count() <= BROADCAST_ROWS else own


def _needed(pairs: DataFrame, words: DataFrame, heads: DataFrame) -> DataFrame:
    """(term, shard, least): impact that a block of the term must have to be of use there."""
    each = pairs.join(words, "query_id").join(heads, ["term", "shard"])
    least = F.col("greatest") + (F.col("floor") - SLACK - F.col("bound")) / F.col("w")
    return each.groupBy("term", "shard").agg(F.min(least).alias("least"))


def read_blocks(
    blocks: DataFrame, pairs: DataFrame, words: DataFrame, heads: DataFrame
) -> DataFrame:
    """The blocks that the pairs (query_id, shard, bound, floor) need.

    What is too much to be sent to all tasks is first looked up by layer, so that only blocks
    that some shard of the layer needs are shuffled.
    """
    needed = materialize(_needed(pairs, words, heads))
    if needed.count() <= BROADCAST_ROWS:
        needed = F.broadcast(needed)
    else:
        layer = F.shiftright("shard", 40).alias("layer")
        rough = materialize(needed.groupBy("term", layer).agg(F.min("least").alias("rough")))
        if rough.count() <= BROADCAST_ROWS:
            blocks = blocks.withColumn("layer", layer).join(F.broadcast(rough), ["term", "layer"])
            blocks = blocks.where("greatest >= rough").drop("layer", "rough")
    return blocks.join(needed, ["term", "shard"]).where("greatest >= least").drop("least")


def _scored(
    asked: DataFrame, pairs: DataFrame, blocks: DataFrame, k: int, schema, cuts: int
) -> DataFrame:
    """Best rows of each pair's shard that reach the question's floor."""
    id_type = to_arrow_type(schema["row_id"].dataType)
    cut = F.pmod(F.xxhash64("query_id"), F.lit(cuts)).cast("int")
    right = asked.join(pairs, "query_id").withColumn("cut", cut)
    left = blocks.withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(cuts - 1))))

    def run(some: pa.Table, questions: pa.Table) -> pa.Table:
        lists = some["rows"].combine_chunks()
        size = pc.list_value_length(lists).to_numpy()
        ids = pc.list_flatten(lists)
        weight = pc.list_flatten(some["weights"].combine_chunks()).to_numpy()
        known = pc.unique(ids)
        known = known.take(pc.sort_indices(known))
        row = pc.index_in(ids, value_set=known).to_numpy() if len(ids) else np.zeros(0, np.int64)
        begin = np.concatenate(([0], np.cumsum(size)))
        of_term: dict[str, list[int]] = {}
        for b, term in enumerate(some["term"].to_pylist()):
            of_term.setdefault(term, []).append(b)
        columns = {f.name: [] for f in schema}
        if len(known):
            for q in questions.to_pylist():
                total = np.zeros(len(known))
                for term, w in zip(q["terms"], q["weights"]):
                    for b in of_term.get(term, ()):
                        part = slice(begin[b], begin[b + 1])
                        total[row[part]] += w * weight[part]
                met = total > 0
                total = np.round(total, DECIMALS)
                wanted = k if q["limit"] is None else q["limit"]
                hit = np.flatnonzero(met & (total >= q["floor"] - SLACK))
                best = hit[np.lexsort((hit, -total[hit]))[: max(0, wanted)]]
                columns["query_id"] += [q["query_id"]] * len(best)
                columns["row_id"] += known.take(pa.array(best, pa.int64())).to_pylist()
                columns["score"] += total[best].tolist()
                columns["limit"] += [q["limit"]] * len(best)
        kinds = (to_arrow_type(schema["query_id"].dataType), id_type, pa.float64(), pa.int32())
        return pa.table([pa.array(c, t) for c, t in zip(columns.values(), kinds)], names=list(columns))

    return left.groupBy("shard", "cut").cogroup(right.groupBy("shard", "cut")).applyInArrow(
        run, schema
    )


def nearest_posted(
    blocks: DataFrame, questions: DataFrame, k: int, shape: Shape = Shape()
) -> DataFrame:
    """``query_id, rank, row_id, score`` as ``nearest`` gives them for terms, exactly."""
    rows = blocks.select(F.element_at("rows", 1).alias("row_id"), "weights", F.array("term").alias("terms"))
    asked = materialize(
        _question_columns(questions, rows, "terms").select("query_id", "terms", "weights", "limit")
    )
    schema = _result_schema(asked, rows)
    cuts = max(1, -(-asked.count() // shape.questions))
    words = asked.select("query_id", F.explode(F.arrays_zip("terms", "weights")).alias("t")).select(
        "query_id", F.col("t.terms").alias("term"), F.col("t.weights").alias("w")
    ).where("w > 0")
    words = materialize_for_join(words, BROADCAST_ROWS)
    blocks = own_buckets(blocks, words)
    heads, bounds = bound_pairs(blocks, words)
    best = bounds.groupBy("query_id").agg(F.max_by("shard", F.struct("bound", "shard")).alias("shard"))
    first = bounds.join(best, ["query_id", "shard"]).withColumn("floor", F.lit(0.0))
    found = materialize(
        _scored(asked, first, read_blocks(blocks, first, words, heads), k, schema, cuts)
    )
    later = second_round(asked, bounds, best, found, k)
    more = _scored(asked, later, read_blocks(blocks, later, words, heads), k, schema, cuts)
    return _ranked(found.union(more), k)


def bound_pairs(blocks: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First blocks' (term, shard, greatest), and (query_id, shard, bound)."""
    heads = materialize(blocks.where("block = 0").select("term", "shard", "greatest"))
    bounds = words.join(heads, "term").groupBy("query_id", "shard").agg(
        F.sum(F.col("w") * F.col("greatest")).alias("bound")
    )
    return heads, materialize(bounds)


def second_round(
    asked: DataFrame, bounds: DataFrame, best: DataFrame, found: DataFrame, k: int
) -> DataFrame:
    """Pairs left to read: (query_id, shard, bound, floor)."""
    wanted = F.coalesce("limit", F.lit(k))
    floors = (
        found.groupBy("query_id")
        .agg(F.sort_array(F.collect_list("score"), False).alias("scores"), F.first("limit").alias("limit"))
        .select("query_id", F.get("scores", wanted - 1).alias("floor"))
    )
    left = bounds.join(best, ["query_id", "shard"], "left_anti").join(floors, "query_id", "left")
    return left.withColumn("floor", F.coalesce("floor", F.lit(0.0))).where(
        F.col("bound") >= F.col("floor") - SLACK
    )
