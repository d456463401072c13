"""Toxicity scores, learnt from confirmed toxic documents and unlabelled text.

Classifiers (``classifier.py``) are trained side by side on executors, each on its own part
of a sample; their weights are averaged. The sample is bounded: POSITIVE toxic documents
and UNLABELLED documents of any kind for each of up to MEMBERS classifiers, those with the
smallest hashes of their ids, outside the held-out quarter. The class prior is the share of toxic rows among all
labels outside that quarter. Scoring reads all rows and whole texts, inside each task.

Cases: null text is empty; texts without known words get the score of the bias; a null id
is not held out; repeated rows are scored each; ids with several labels count as toxic if
one says so, null labels and labels without an id are left out; of several texts of one id
that with the smallest hash is learnt from; texts are scored whole, however long; without a toxic label all scores are 0; an empty
table gives no rows. Language, source and id are no inputs of a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscope.llm import classifier
from corpuscope.llm.common import NULL_ID, give_back, id_back, id_key, in_tasks, texts

MEMBERS = 8
#: Documents per classifier.
POSITIVE = 500
UNLABELLED = 1_500
KNOWN = 100_000
HELD_OUT = 2
THRESHOLD = 0.3


def held_out(column: str) -> Column:
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == HELD_OUT


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], float] | None:
    """({feature: weight}, bias), or None without a toxic label."""
    known = F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()
    mine = labels.where(known & ~held_out("doc_id"))
    mine = mine.groupBy(id_key("doc_id").alias("doc")).agg(F.max("toxic").alias("toxic"))
    total, toxic = mine.agg(F.count("*"), F.sum("toxic")).first()
    if not toxic:
        return None
    prior = min(0.99, max(0.001, toxic / total))
    members = min(MEMBERS, -(-toxic // POSITIVE))

    def first(ids: DataFrame, n: int, positive: bool) -> DataFrame:
        order = F.xxhash64("doc")
        return ids.orderBy(order, "doc").limit(n).select("doc", F.lit(positive).alias("positive"))

    free = docs.where(~held_out("doc_id")).select(id_key("doc_id").alias("doc"))
    chosen = first(mine.where("toxic = 1"), members * POSITIVE, True).union(
        first(free.distinct(), members * UNLABELLED, False)
    )
    sample = (
        texts(docs)
        .join(F.broadcast(chosen), "doc")
        .groupBy("doc", "positive")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        .withColumn("member", F.pmod(F.xxhash64("doc", F.lit(7)), F.lit(members)))
    )

    def train(rows):
        positive = rows.text[rows.positive].tolist()
        unlabelled = rows.text[~rows.positive].tolist()
        if not positive or not unlabelled:
            return _frame({}, 0.0, 0)
        found = _frame(*classifier.train(positive, unlabelled, prior), 1)
        give_back()
        return found

    found = sample.groupBy("member").applyInPandas(
        train, "feature string, weight double, member int"
    )
    summed = found.groupBy("feature").agg(F.sum("weight"), F.sum("member")).collect()
    weights = {r[0]: (r[1], r[2]) for r in summed}
    bias, members = weights.pop("", (0.0, 0))
    if not members:
        return None
    return {f: w / members for f, (w, _) in weights.items()}, bias / members


def _frame(weights: dict[str, float], bias: float, member: int):
    import pandas as pd

    return pd.DataFrame(
        {
            "feature": ["", *weights],
            "weight": [bias, *map(float, weights.values())],
            "member": [member] * (1 + len(weights)),
        }
    )


def scorer(model: tuple[dict[str, float], float] | None):
    """Function from a text to its score."""
    if model is None:
        return lambda text: 0.0
    weights, bias = model
    number = {f: k for k, f in enumerate(weights)}
    value = np.array(list(weights.values()), dtype=float)
    known: dict[str, tuple[int, ...]] = {}

    def of(word: str) -> tuple[int, ...]:
        if len(known) > KNOWN:
            known.clear()
        parts = [word, *(word[:k] + "-" for k in classifier.PREFIXES if len(word) > k)]
        known[word] = found = tuple(number[p] for p in parts if p in number)
        return found

    def score(text: str) -> float:
        words = classifier.Counter(classifier.WORD.findall(text.lower()))
        counts: dict[int, int] = {}
        get = counts.get
        for word, n in words.items():
            places = known.get(word)
            for p in of(word) if places is None else places:
                counts[p] = get(p, 0) + n
        at = np.fromiter(counts, dtype=np.int64, count=len(counts))
        n = np.fromiter(counts.values(), dtype=float, count=len(counts))
        total = bias + float(value[at] @ classifier.weight(n, sum(words.values())))
        return float(classifier.sigmoid(total))

    return score


def score(docs: DataFrame, model) -> DataFrame:
    """Per row: doc, score."""
    model = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        one = scorer(model.value)
        for batch in batches:
            found = [one(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())], names=["doc", "score"]
            )

    return in_tasks(texts(docs), run, "doc long, score double")


def reject(docs: DataFrame, model, threshold: float) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold."""
    model = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches):
        one = scorer(model.value)
        for batch in batches:
            keep = [one(t.as_py() or "") < threshold for t in batch.column(place)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return in_tasks(docs, run, docs.schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = score(docs, fit(docs, labels))
    text = F.when(F.col("doc") != NULL_ID, F.col("doc").cast("string")).otherwise("")
    return rows.select(
        id_back(),
        (F.crc32(text.cast("binary")) % 4 == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
