"""Best k rows per question: exact, filtered, diverse and approximate.

Questions: ``query_id``, the vector column(s), optionally ``filter`` (JSON of a
metadata filter) and ``limit``. Rows: ``row_id``, the vector column(s), and any
attribute the filters use. Results: ``query_id, rank, row_id, score``.

No question/row pair is ever a row of a DataFrame. A task scores its rows
against a block of questions with numpy and emits at most k rows per question.

With many dense questions copies are scored once: of rows with the same vector and attributes
only as many stay as a question may want, those with the smallest ids, and questions that ask
the same are asked as one, whose results each of them gets.
"""

from __future__ import annotations

import itertools
import json
import math
from functools import reduce
from operator import and_, or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpuscope.config import EngineConfig
from corpuscope.functions.topk import DECIMALS, score_batches
from corpuscope.operators.filters import problem, to_column
from corpuscope.session import materialize, materialize_for_join

METRICS = ("cosine", "l2", "terms")
#: Questions from which on a row costs more to score than to move to its copies.
MANY = 256
#: Greatest bytes of vectors per side of a cell.
MOST_CELL_BYTES = 64 << 20
#: Pairs of a question and a row that one task scores at most: tasks grow in number, not in length.
MOST_PAIRS = 1 << 30
#: Different filters of a batch that are looked for in the scan already.
MOST_FILTERS = 64


def _vector_columns(kind: str) -> list[str]:
    if kind not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    return ["terms", "weights"] if kind == "terms" else ["embedding"]


def _attribute_types(rows: DataFrame) -> dict[str, str]:
    """Columns of the rows a filter may name."""
    vectors = {"embedding", "terms", "weights"}
    return {name: kind for name, kind in rows.dtypes if name not in vectors}


def _filter_problem(types: dict[str, str]):
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        known = {t: problem(t, types) for t in texts.dropna().unique()}
        return texts.map(lambda t: known.get(t)).astype(object)

    return run


def question_warnings(questions: DataFrame, rows: DataFrame) -> DataFrame:
    """``query_id, class, message`` of questions that cannot be used on the rows as asked.

    ``invalid_filter``: they get no results; the other questions of the batch are not touched.
    ``vector_length``: only rows with vectors of the question's own length are compared, and
    some have others.
    """
    found = _length_warnings(questions, rows)
    if "filter" not in questions.columns:
        return found
    bad = questions.where(F.col("filter").isNotNull()).select(
        "query_id", _filter_problem(_attribute_types(rows))("filter").alias("message")
    )
    return bad.where(F.col("message").isNotNull()).select(
        "query_id", F.lit("invalid_filter").alias("class"), "message"
    ).union(found)


def _length_warnings(questions: DataFrame, rows: DataFrame) -> DataFrame:
    texts = F.lit("").alias("class"), F.lit("").alias("message")
    if "embedding" not in questions.columns or "embedding" not in rows.columns:
        return questions.select("query_id", *texts).limit(0)
    whole = rows.where(F.col("embedding").isNotNull())
    # One row for each length.
    lengths = whole.groupBy(F.size("embedding").alias("length")).agg(F.count("*").alias("own"))
    total = whole.count()
    asked = questions.where(F.col("embedding").isNotNull()).select(
        "query_id", F.size("embedding").alias("length")
    )
    others = F.lit(total) - F.coalesce("own", F.lit(0))
    message = F.concat(
        others, F.lit(f" of {total} rows have vectors of another length than "), F.col("length")
    )
    return (
        asked.join(F.broadcast(lengths), "length", "left")
        .where(others > 0)
        .select("query_id", F.lit("vector_length").alias("class"), message.alias("message"))
    )


def _question_columns(questions: DataFrame, rows: DataFrame, kind: str) -> DataFrame:
    present = set(questions.columns)
    null = F.lit(None)
    usable = questions.where(F.col(_vector_columns(kind)[0]).isNotNull())
    if "filter" in present:
        message = _filter_problem(_attribute_types(rows))("filter")
        usable = usable.where(F.col("filter").isNull() | message.isNull())
    columns = {
        "query_id": F.col("query_id"),
        **{c: F.col(c) for c in _vector_columns(kind)},
        "filter": (F.col("filter") if "filter" in present else null).cast("string"),
        "limit": (F.col("limit") if "limit" in present else null).cast("int"),
    }
    # Under names of their own first: questions may be made from the rows themselves.
    own = usable.select(*(c.alias(f"_asked_{n}") for n, c in columns.items()))
    return own.select(*(F.col(f"_asked_{n}").alias(n) for n in columns))


def _vector_bytes(kind: str) -> Column:
    vector = (
        F.aggregate("terms", F.lit(0), lambda n, t: n + F.octet_length(t) + 16)
        if kind == "terms"
        else F.size("embedding") * 8
    )
    return F.coalesce(vector, F.lit(0)).cast("long") + 64


def _look_at(
    questions: DataFrame, kind: str, rows: DataFrame, k: int = 0
) -> tuple[int, list[str], int, int]:
    """Bytes of the question side, the attributes its filters name, the number of questions
    and the most rows that one of them wants.

    Only usable filters are left, so the names are columns of the rows.
    """
    names = [
        F.max(F.contains(F.col("filter"), F.lit(f'"{n}"'))).alias(f"_{k}")
        for k, n in enumerate(_attribute_types(rows))
    ]
    size = _vector_bytes(kind) + F.coalesce(F.octet_length("filter"), F.lit(0))
    most = F.max(F.coalesce("limit", F.lit(k)))
    seen = questions.agg(
        F.coalesce(F.sum(size), F.lit(0)), F.count("*"), F.coalesce(most, F.lit(0)), *names
    ).first()
    named = [n for n, hit in zip(_attribute_types(rows), seen[3:]) if hit]
    return int(seen[0]), [name for name in named if name != "row_id"], int(seen[1]), int(seen[2])


def _first_copies(rows: DataFrame, same: list[str], most: int) -> DataFrame:
    """The ``most`` smallest ids of rows that agree in ``same``: no question gets more of them.

    Each task sends on as many of a vector at most, so that a frequent one gathers few rows.
    """
    place = Window.partitionBy(F.xxhash64(*same), *same).orderBy("row_id")
    first = rows.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= most)
    return first.drop("_place")


def _asked_once(questions: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Different questions under numbers of their own, and the number of each ``query_id``;
    none if hardly any question is a copy."""
    same = ["embedding", "filter", "limit"]
    grouped = questions.groupBy(*same).agg(F.count("*").alias("_n"))
    different = materialize(grouped.withColumn("_number", F.monotonically_increasing_id()))
    n, total = different.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    if 10 * n > 9 * total:
        return None
    asked = different.select(F.col("_number").alias("query_id"), *same)
    named = different.select("_number", *(F.col(c).alias(f"_same_{c}") for c in same))
    alike = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_same_{c}")) for c in same))
    return asked, questions.join(named, alike).select("query_id", "_number", "limit")


def _wanted_by_any(questions: DataFrame, rows: DataFrame, attributes: list[str]) -> DataFrame:
    """Rows that the filter of at least one question lets through.

    Only if every question has a filter, and there are at most MOST_FILTERS different ones: then
    what they have in common is a predicate of the scan. The questions' own filters are
    applied when scoring, so the result is the same without it.
    """
    if not attributes:
        return rows
    found = questions.select("filter").distinct().limit(MOST_FILTERS + 1).collect()
    if len(found) > MOST_FILTERS or any(not r[0] for r in found):
        return rows
    return rows.where(reduce(or_, (to_column(json.loads(r[0])) for r in found), F.lit(False)))


def _result_schema(questions: DataFrame, rows: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", questions.schema["query_id"].dataType),
            T.StructField("row_id", rows.schema["row_id"].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("limit", T.IntegerType()),
        ]
    )


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "row_id")
    return (
        candidates.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= F.coalesce("limit", F.lit(k)))
        .select("query_id", "rank", "row_id", "score")
    )


def nearest(
    questions: DataFrame,
    rows: DataFrame,
    k: int,
    kind: str = "cosine",
    config: EngineConfig = EngineConfig(),
) -> DataFrame:
    """Exact top k, or as many rows as the question's own ``limit``. ``kind``: ``cosine``,
    ``l2`` (score is minus the distance) or ``terms``. Scores have six decimals; what is
    equal then is ordered by ``row_id``."""
    questions = _question_columns(questions, rows, kind)
    size, attribute_names, n_questions, most = _look_at(questions, kind, rows, k)
    rows = rows.select("row_id", *_vector_columns(kind), *attribute_names)
    rows = rows.where(F.col(_vector_columns(kind)[0]).isNotNull())
    rows = _wanted_by_any(questions, rows, attribute_names)
    if kind == "terms" or n_questions < MANY:
        return _ranked(_candidates(questions, rows, size, k, kind, config), k)
    # Stored: their number decides how they are dealt out.
    rows = materialize(_first_copies(rows, ["embedding", *attribute_names], most))
    once = _asked_once(questions)
    if once is None:
        return _ranked(_candidates(questions, rows, size, k, kind, config), k)
    asked, numbers = once
    size = _look_at(asked, kind, rows)[0]
    best = _ranked(_candidates(asked, rows, size, k, kind, config), k)
    best = materialize_for_join(
        best.select(F.col("query_id").alias("_number"), "row_id", "score"), config.broadcast_rows
    )
    return _ranked(numbers.join(best, "_number"), k)


def _candidates(
    questions: DataFrame, rows: DataFrame, size: int, k: int, kind: str, config: EngineConfig
) -> DataFrame:
    """The best rows of each question in each task; ``size`` is that of the questions."""
    n_questions = 0 if kind == "terms" else questions.count()
    if size <= config.broadcast_bytes:
        if n_questions < MANY:
            return _against_broadcast(questions, rows, k, kind, config)
        return _in_parts(questions, rows, k, kind, config)
    row_bytes, n_rows = rows.agg(F.sum(_vector_bytes(kind)), F.count("*")).first()
    cuts = _cuts([row_bytes or 0, size], _scoring_tasks(rows, config), config)
    cuts = _finer(cuts, n_questions * n_rows)
    return _scored_cells(
        _spread(questions, "query_id", "question_cut", cuts[1], "row_cut", cuts[0]),
        _spread(rows, "row_id", "row_cut", cuts[0], "question_cut", cuts[1]),
        ["row_cut", "question_cut"], k, kind, 2 * cuts[0] * cuts[1],
    )


def _scoring_tasks(rows: DataFrame, config: EngineConfig) -> int:
    return config.tasks_per_core * rows.sparkSession.sparkContext.defaultParallelism


def _cuts(sizes: list[int], tasks: int, config: EngineConfig) -> list[int]:
    """Into how many parts the rows and the questions are cut.

    Each side is copied to every part of the other, so cells of ``cell_bytes`` are only made
    while they are no more than the tasks; beyond, cells grow up to MOST_CELL_BYTES a side.
    """
    wanted = [max(1, -(-n // config.cell_bytes)) for n in sizes]
    most_bytes = max(config.cell_bytes, MOST_CELL_BYTES)
    least = [max(1, -(-n // most_bytes)) for n in sizes]
    shrink = max(1.0, (wanted[0] * wanted[1] / tasks) ** 0.5)
    return [max(low, int(n / shrink)) for low, n in zip(least, wanted)]


def _finer(cuts: list[int], pairs: int) -> list[int]:
    """Both sides cut further, until a cell has about MOST_PAIRS pairs."""
    more = max(1.0, (pairs / MOST_PAIRS / (cuts[0] * cuts[1])) ** 0.5)
    return [math.ceil(n * more) for n in cuts]


def _spread(side: DataFrame, key: str, own: str, n: int, other: str, copies: int) -> DataFrame:
    """Each row in the cut its id hashes to, once for each cut of the other side."""
    mine = F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    theirs = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    return side.withColumn(own, mine).withColumn(other, theirs)


def _scored_cells(
    questions: DataFrame, rows: DataFrame, keys: list[str], k: int, kind: str, tasks: int
) -> DataFrame:
    """Cells dealt over ``tasks``: left to the session's number, or put together by their bytes,
    a task would get more of them as they grow in number."""
    id_type = to_arrow_type(rows.schema["row_id"].dataType)

    def run(some_questions: pa.Table, some_rows: pa.Table) -> pa.Table:
        return score_batches([some_rows], some_questions, kind, k, id_type)

    left, right = (side.repartition(tasks, *keys).groupBy(*keys) for side in (questions, rows))
    return left.cogroup(right).applyInArrow(run, _result_schema(questions, rows))


def _against_broadcast(
    questions: DataFrame, rows: DataFrame, k: int, kind: str, config: EngineConfig
) -> DataFrame:
    """Rows stay where they are; the size-checked questions go to every task.

    A task sends on the best rows of every question, so splits are read by a number of
    tasks that follows the cores, not the data.
    """
    schema = _result_schema(questions, rows)
    id_type = to_arrow_type(rows.schema["row_id"].dataType)
    shared = rows.sparkSession.sparkContext.broadcast(questions.toArrow())

    def run(batches):
        if shared.value.num_rows:
            yield from score_batches(batches, shared.value, kind, k, id_type).to_batches()

    return rows.coalesce(_scoring_tasks(rows, config)).mapInArrow(run, schema)


def _in_parts(
    questions: DataFrame, rows: DataFrame, k: int, kind: str, config: EngineConfig
) -> DataFrame:
    """A task meets one part of the rows with one part of the size-checked questions.

    Cut on both sides, the tasks send on fewer rows of a question than if each had all questions;
    there are more of them once they would have over MOST_PAIRS pairs.
    """
    schema = _result_schema(questions, rows)
    id_type = to_arrow_type(rows.schema["row_id"].dataType)
    asked = questions.toArrow()
    row_cuts, question_cuts = _finer(
        [math.ceil(_scoring_tasks(rows, config) ** 0.5)] * 2, asked.num_rows * rows.count()
    )
    shared = rows.sparkSession.sparkContext.broadcast(asked)
    dealt = _spread(rows, "row_id", "_own", row_cuts, "_other", question_cuts)
    dealt = dealt.withColumn("_cell", F.col("_own") * question_cuts + F.col("_other"))
    dealt = dealt.drop("_own", "_other").repartitionById(row_cuts * question_cuts, "_cell")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            # A task has one cell.
            part = batch.column("_cell")[0].as_py() % question_cuts
            ends = [n * shared.value.num_rows // question_cuts for n in (part, part + 1)]
            some = shared.value.slice(ends[0], ends[1] - ends[0])
            if some.num_rows:
                every = itertools.chain([batch], batches)
                yield from score_batches(every, some, kind, k, id_type).to_batches()
            return

    return dealt.mapInArrow(run, schema)


def _in_cells(
    questions: DataFrame, rows: DataFrame, k: int, kind: str, config: EngineConfig
) -> DataFrame:
    """Score questions against the rows of the same ``cell``.

    A cell of any size is cut into sub-cells of at most about ``cell_rows``
    rows and as many questions, so that no task gets more than that. Both sides
    are spread by hash of their unique id and copied to the other side's cuts.
    """

    def counted(side: DataFrame, name: str) -> DataFrame:
        return materialize(side.groupBy("cell").agg(F.count("*").alias(name)))

    def cuts(sizes: DataFrame, of: str, name: str) -> DataFrame:
        # Only cells that need more than one cut are kept: few rows.
        n = F.ceil(F.col(of) / config.cell_rows).cast("int").alias(name)
        return sizes.select("cell", n).where(F.col(name) > 1)

    n_rows, n_questions = counted(rows, "n_rows"), counted(questions, "n_questions")
    row_cuts = cuts(n_rows, "n_rows", "row_cuts")
    question_cuts = cuts(n_questions, "n_questions", "question_cuts")
    # As doubles: a number of tasks need not be exact.
    product = F.sum(F.col("n_rows").cast("double") * F.col("n_questions"))
    pairs = n_rows.join(n_questions, "cell").agg(product).first()[0] or 0
    tasks = max(_scoring_tasks(rows, config), math.ceil(pairs / MOST_PAIRS))

    def spread(side: DataFrame, key: str, own: str, other: str) -> DataFrame:
        side = side.join(row_cuts, "cell", "left").join(question_cuts, "cell", "left")
        mine = F.pmod(F.xxhash64(key), F.coalesce(own, F.lit(1))).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        return side.withColumn(own, mine).withColumn(other, theirs)

    return _scored_cells(
        spread(questions, "query_id", "question_cuts", "row_cuts"),
        spread(rows, "row_id", "row_cuts", "question_cuts"),
        ["cell", "row_cuts", "question_cuts"], k, kind, tasks,
    )


# --- approximate -----------------------------------------------------------------
def nearest_approximate(
    questions: DataFrame,
    rows: DataFrame,
    k: int,
    kind: str = "l2",
    tables: int = 8,
    width: int = 3,
    bucket_length: float = 0.4,
    seed: int = 17,
    config: EngineConfig = EngineConfig(),
) -> DataFrame:
    """Top k among rows that share a random-projection bucket with the question.

    A bucket is the joint value of ``width`` projections; there are ``tables`` of
    them, and sharing one is enough. Candidates are scored exactly. Buckets that hold many rows are cut, never
    truncated, so the result depends on the hash functions only.
    """
    questions = _question_columns(questions, rows, kind)
    _, attribute_names, *_ = _look_at(questions, kind, rows)
    rows = rows.select("row_id", "embedding", *attribute_names)
    hasher = BucketedRandomProjectionLSH(
        inputCol="v", outputCol="hashes", numHashTables=tables * width, bucketLength=bucket_length,
        seed=seed,
    )

    def vectorised(side: DataFrame) -> DataFrame:
        return side.withColumn("v", array_to_vector(F.col("embedding").cast("array<double>")))

    model = hasher.fit(vectorised(rows))

    def hashed(side: DataFrame) -> DataFrame:
        hashes = F.col("hashes").cast("array<string>")
        cells = F.transform(
            F.sequence(F.lit(0), F.lit(tables - 1)),
            lambda t: F.xxhash64(t, F.slice(hashes, t * width + 1, F.lit(width))),
        )
        return model.transform(vectorised(side)).select(
            *side.columns, F.explode(cells).alias("cell")
        )

    asked = hashed(questions)
    # Rows in buckets that no question falls into need not be shuffled.
    cells = materialize_for_join(asked.select("cell").distinct(), config.broadcast_rows)
    kept = hashed(rows).join(cells, "cell", "left_semi")
    candidates = _in_cells(asked, kept, k, kind, config)
    unique = candidates.groupBy("query_id", "row_id").agg(
        F.max("score").alias("score"), F.max("limit").alias("limit")
    )
    return _ranked(unique, k)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """``n_expected, n_found, recall`` of approximate against exact results."""
    found = approximate.select("query_id", "row_id", F.lit(1).alias("found"))
    joined = exact.join(found, ["query_id", "row_id"], "left")
    return joined.agg(
        F.count("*").alias("n_expected"),
        F.count("found").alias("n_found"),
        F.round(F.count("found") / F.count("*"), DECIMALS).alias("recall"),
    )


# --- diversity -------------------------------------------------------------------
def _greedy(table: pa.Table, k: int, weight: float, kind: str) -> pa.Table:
    """Pick rows that are close to the question and far from those picked."""
    table = table.sort_by("rank")
    if kind == "terms":
        vocabulary: dict[str, int] = {}
        lists = table["terms"].to_pylist()
        codes = [[vocabulary.setdefault(t, len(vocabulary)) for t in terms] for terms in lists]
        m = np.zeros((len(lists), max(1, len(vocabulary))))
        for i, (row, w) in enumerate(zip(codes, table["weights"].to_pylist())):
            m[i, row] = w
    else:
        m = np.array(table["embedding"].to_pylist(), dtype=np.float64)
        m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    relevance = table["score"].to_numpy()
    alike = np.round(m @ m.T, DECIMALS)
    picked, nearest_picked = [], np.zeros(len(m))
    for step in range(min(k, len(m))):
        gain = weight * relevance - (1 - weight) * nearest_picked
        gain = np.round(gain, DECIMALS + 3)  # equal gains stay equal
        gain[picked] = -np.inf
        best = int(np.argmax(gain))
        picked.append(best)
        nearest_picked = alike[best] if step == 0 else np.maximum(nearest_picked, alike[best])
    chosen = table.take(pa.array(picked, pa.int64()))
    rank = pa.array(np.arange(1, len(picked) + 1), pa.int32())
    return pa.table(
        {
            "query_id": chosen["query_id"], "rank": rank, "row_id": chosen["row_id"],
            "score": chosen["score"],
        }
    )


def nearest_diverse(
    questions: DataFrame,
    rows: DataFrame,
    k: int,
    kind: str = "cosine",
    fetch_k: int = 20,
    weight: float = 0.5,
    config: EngineConfig = EngineConfig(),
) -> DataFrame:
    """Maximal marginal relevance over the ``fetch_k`` most similar rows, of which k or
    the question's own ``limit`` are picked.

    A group holds at most ``fetch_k`` or ``limit`` rows of one question.
    """
    if kind == "l2":
        raise ValueError("diversity needs similarities: use cosine or terms")
    own = F.col("limit") if "limit" in questions.columns else F.lit(None)
    take = F.coalesce(own.cast("int"), F.lit(k))
    fetched = questions.withColumn("limit", F.greatest(take, F.lit(fetch_k)))
    best = nearest(fetched, rows, fetch_k, kind, config)
    wanted = questions.select("query_id", take.alias("take"))
    found = materialize_for_join(best.join(wanted, "query_id"), config.broadcast_rows)
    with_vectors = rows.select("row_id", *_vector_columns(kind)).join(found, "row_id")
    schema = T.StructType(
        [
            T.StructField("query_id", best.schema["query_id"].dataType),
            T.StructField("rank", T.IntegerType()),
            T.StructField("row_id", best.schema["row_id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return with_vectors.groupBy("query_id").applyInArrow(
        lambda table: _greedy(table, max(0, table["take"][0].as_py()), weight, kind), schema
    )
