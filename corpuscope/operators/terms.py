"""Term weights: relational TF-IDF with unit-length document vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscope.config import EngineConfig
from corpuscope.functions.arrays import counts
from corpuscope.functions.text import terms
from corpuscope.session import materialize

#: Counts of a batch that are weighed at once.
_ENTRIES = 1 << 19
#: Bytes of a packed posting: its code and its count.
_BYTES = 8

_COUNT = T.StructType(
    [T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType())]
)


@dataclass(frozen=True)
class Vocabulary:
    """Document frequencies of a corpus. ``table`` has ``term, df``."""

    table: DataFrame
    n_docs: int
    n_terms: int
    n_pairs: int


def term_counts(
    docs: DataFrame, text: str = "page_content", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``row_id, counts``: terms of each document, counted inside its row."""
    return docs.select("row_id", *keep, counts(terms(F.col(text))).alias("counts"))


def frequencies(docs: DataFrame, text: str = "page_content") -> DataFrame:
    """``term, df``. Only partial counts per term are shuffled."""
    distinct = F.array_distinct(terms(F.col(text)))
    return (
        docs.select(F.explode(distinct).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    )


def frequencies_of(counted: DataFrame) -> DataFrame:
    """``term, df`` of stored term counts; no text is read again."""
    rows = counted.select(F.explode("counts.term").alias("term"))
    return rows.groupBy("term").agg(F.count("*").alias("df"))


def changed_frequencies(before: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """``term, df`` after rows came and went: signed differences, nothing else is counted."""
    minus = removed.select("term", (-F.col("df")).alias("df"))
    rows = before.select("term", "df").unionByName(added).unionByName(minus)
    return rows.groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")


def vocabulary_of(table: DataFrame, n_docs: int) -> Vocabulary:
    size = table.agg(F.count("*"), F.coalesce(F.sum("df"), F.lit(0))).first()
    return Vocabulary(table, n_docs, int(size[0]), int(size[1]))


def fit(docs: DataFrame, text: str = "page_content") -> Vocabulary:
    return vocabulary_of(materialize(frequencies(docs, text)), docs.count())


def _frequent_cut(vocabulary: Vocabulary, config: EngineConfig) -> int:
    """Frequency from which a term is broadcast: the lowest whose terms keep to both bounds.

    As many terms as may be are looked up inside the document's row, and only postings of
    the rest are shuffled. Frequencies add up to ``n_pairs``, so at most ``broadcast_terms``
    terms can reach ``n_pairs / broadcast_terms``, and a term below the cut holds too small
    a share of all rows to skew a shuffle.
    """
    # Different frequencies add up to n_pairs at most as well: no more than sqrt(2 n_pairs) rows.
    steps = (
        vocabulary.table.groupBy("df")
        .agg(F.count("*").alias("n"), F.sum(F.octet_length("term")).alias("size"))
        .orderBy(F.desc("df"))
        .collect()
    )
    terms_held = bytes_held = 0
    cut = steps[0].df + 1 if steps else 0
    for step in steps:
        terms_held, bytes_held = terms_held + step.n, bytes_held + step["size"]
        if terms_held > config.broadcast_terms or bytes_held > config.broadcast_bytes:
            return cut
        cut = step.df
    return 0


def _pieces(batch: pa.RecordBatch, size: np.ndarray | None = None):
    """Parts of a batch of about _ENTRIES counts, of whole rows."""
    if size is None:
        size = pc.fill_null(pc.list_value_length(batch.column("counts")), 0).to_numpy()
    ends = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        limit = (ends[at - 1] if at else 0) + _ENTRIES
        end = max(at + 1, int(np.searchsorted(ends, limit, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _codes(texts: pa.Array, known: pa.Array) -> np.ndarray:
    """Places of the texts in ``known``, -1 for others.

    The few different texts are hashed and not ``known``, which takes a hundred MB and more.
    """
    coded = texts.dictionary_encode()
    at = pc.index_in(known, value_set=coded.dictionary)
    met = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    place = np.full(len(coded.dictionary), -1, dtype=np.int32)
    place[at.drop_null().to_numpy()] = met
    return place[coded.indices.to_numpy()]


def _lists(owner: np.ndarray, n: int, values: pa.Array) -> pa.ListArray:
    ends = np.cumsum(np.bincount(owner, minlength=n))
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return pa.ListArray.from_arrays(offsets, values)


def _schema(carried: list[T.StructField], **lists: T.DataType) -> T.StructType:
    return T.StructType(carried + [T.StructField(n, T.ArrayType(t)) for n, t in lists.items()])


def _shared(spark, frequent: DataFrame):
    """Broadcast of the terms, the most frequent first: their places are the smallest numbers."""
    return spark.sparkContext.broadcast(
        frequent.select("term", "df").toArrow().sort_by([("df", "descending")])
    )


def _known(shared, n_docs: int) -> tuple[pa.Array, np.ndarray]:
    log_of_known = np.log((n_docs + 1.0) / (shared.value["df"].to_numpy() + 1.0))
    return shared.value["term"].combine_chunks(), log_of_known


def _unit_length(weight: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Weights divided by the norm of their row; squares are added in the order of the row."""
    norm = np.sqrt(np.bincount(owner, weight * weight, minlength=n))[owner]
    return np.divide(weight, norm, out=np.zeros(len(weight)), where=norm > 0)


def _all_weights(counted: DataFrame, shared, n_docs: int) -> DataFrame:
    """``terms, weights`` in the place of ``counts``, where the whole vocabulary is broadcast:
    what is not in it has frequency 0."""
    carried = [f for f in counted.schema.fields if f.name != "counts"]
    schema = _schema(carried, terms=T.StringType(), weights=T.DoubleType())

    def run(batches):
        known, log_of_known = _known(shared, n_docs)
        for whole in batches:
            codes, first = _codes(pc.list_flatten(whole.column("counts")).field("term"), known), 0
            for batch in _pieces(whole):
                n = batch.num_rows
                owner = pc.list_parent_indices(batch.column("counts")).to_numpy()
                entries = pc.list_flatten(batch.column("counts"))
                tf = entries.field("tf").to_numpy()
                code, first = codes[first : first + len(tf)], first + len(tf)
                here = code >= 0
                idf = np.full(len(code), np.log(n_docs + 1.0))
                idf[here] = log_of_known[code[here]]
                weight = _unit_length(tf * idf, owner, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(f.name) for f in carried]
                    + [_lists(owner, n, entries.field("term")), _lists(owner, n, pa.array(weight))],
                    names=schema.names,
                )

    return counted.mapInArrow(run, schema)


def _packed(code: np.ndarray, tf: np.ndarray, owner: np.ndarray, n: int) -> pa.BinaryArray:
    """Codes and counts of n rows as bytes that compress well: a row's first bytes of all
    differences of ascending codes, then their second bytes and so on, and its counts alike."""
    order = np.lexsort((code, owner))
    code, tf = code[order].astype(np.int32), tf[order].astype(np.int32)
    size = np.bincount(owner, minlength=n)
    begin = np.cumsum(size) - size
    step = np.diff(code, prepend=np.int32(0))
    first = begin[size > 0]
    step[first] = code[first]
    out = np.empty(len(code) * _BYTES, dtype=np.uint8)
    at = np.arange(len(code)) + (begin * (_BYTES - 1))[owner]
    for plane in range(_BYTES):
        values = step if plane < 4 else tf
        out[at] = values >> (8 * (plane % 4)) & 255
        at += size[owner]
    offsets = np.append(begin, len(code)).astype(np.int64) * _BYTES
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(out)]
    ).cast(pa.binary())


def _unpacked(packed: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, counts and owners of ``_packed`` rows, the codes of a row ascending."""
    size = pc.binary_length(packed).to_numpy() // _BYTES
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(size)), size)
    offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
    data = np.frombuffer(packed.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    at = np.arange(len(owner)) + (begin * (_BYTES - 1))[owner]
    step, tf = np.zeros(len(owner), np.int32), np.zeros(len(owner), np.int32)
    for plane in range(_BYTES):
        values = step if plane < 4 else tf
        values |= data[at].astype(np.int32) << (8 * (plane % 4))
        at += size[owner]
    total = np.cumsum(step, dtype=np.int64)
    before = np.concatenate(([0], total))[begin]
    return (total - before[owner]).astype(np.int32), tf, owner


def _coded(counted: DataFrame, shared) -> DataFrame:
    """``packed, rare`` in the place of ``counts``: rows that are cheap to move.

    A code is the place of a broadcast term; ``rare`` holds the counts of the other terms.
    """
    carried = [f for f in counted.schema.fields if f.name != "counts"]
    schema = T.StructType(
        carried + [T.StructField("packed", T.BinaryType()), T.StructField("rare", T.ArrayType(_COUNT))]
    )

    def run(batches):
        known = shared.value["term"].combine_chunks()
        for whole in batches:
            codes, first = _codes(pc.list_flatten(whole.column("counts")).field("term"), known), 0
            for batch in _pieces(whole):
                n = batch.num_rows
                owner = pc.list_parent_indices(batch.column("counts")).to_numpy()
                entries = pc.list_flatten(batch.column("counts"))
                code, first = codes[first : first + len(owner)], first + len(owner)
                here, rest = code >= 0, np.flatnonzero(code < 0)
                tf = entries.field("tf").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(f.name) for f in carried]
                    + [
                        _packed(code[here], tf[here], owner[here], n),
                        _lists(owner[rest], n, entries.take(pa.array(rest))),
                    ],
                    names=schema.names,
                )

    return counted.mapInArrow(run, schema)


def _decoded(coded: DataFrame, shared, n_docs: int) -> DataFrame:
    """``terms, weights`` in the place of ``packed, rare, found``: a row's broadcast terms in
    their order, then those found by the join."""
    carried = [f for f in coded.schema.fields if f.name not in ("packed", "rare", "found")]
    schema = _schema(carried, terms=T.StringType(), weights=T.DoubleType())

    def run(batches):
        known, log_of_known = _known(shared, n_docs)
        place = np.empty(len(known), np.int32)
        place[pc.sort_indices(known).to_numpy()] = np.arange(len(known))
        for whole in batches:
            size = pc.binary_length(whole.column("packed")).to_numpy() // _BYTES
            for batch in _pieces(whole, size):
                n = batch.num_rows
                code, tf, owner = _unpacked(batch.column("packed"))
                order = np.lexsort((place[code], owner))
                code, tf = code[order], tf[order]
                texts, weight = known.take(pa.array(code)), tf * log_of_known[code]
                found = pc.list_flatten(batch.column("found"))
                if len(found):
                    owner = np.append(owner, pc.list_parent_indices(batch.column("found")).to_numpy())
                    order = np.argsort(owner, kind="stable")
                    texts = pa.concat_arrays([texts, found.field("term")]).take(pa.array(order))
                    weight = np.append(weight, found.field("w").to_numpy())[order]
                    owner = owner[order]
                weight = _unit_length(weight, owner, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(f.name) for f in carried]
                    + [_lists(owner, n, texts), _lists(owner, n, pa.array(weight))],
                    names=schema.names,
                )

    return coded.mapInArrow(run, schema)


def vectors(
    docs: DataFrame,
    vocabulary: Vocabulary,
    text: str = "page_content",
    config: EngineConfig = EngineConfig(),
    keep: tuple[str, ...] = (),
    tasks: int | None = None,
) -> DataFrame:
    """``row_id, *keep, terms, weights`` with weights of unit length per document.

    weight = tf * ln((n_docs + 1) / (df + 1)), divided by the document's norm.
    Documents without terms have empty arrays. While the vocabulary can be broadcast
    nothing is shuffled; beyond that rows travel as numbers of their terms, once, and only
    the rare terms as texts. With ``tasks`` rows are always dealt by ``row_id`` to so many
    tasks, so that a task has all rows of its ids.
    """
    return weighted(term_counts(docs, text, keep), vocabulary, config, keep, tasks)


def weighted(
    counted: DataFrame,
    vocabulary: Vocabulary,
    config: EngineConfig = EngineConfig(),
    keep: tuple[str, ...] = (),
    tasks: int | None = None,
) -> DataFrame:
    """The same from ``row_id, *keep, counts``."""
    counted = counted.select("row_id", *keep, "counts")
    cut = _frequent_cut(vocabulary, config)
    shared = _shared(counted.sparkSession, vocabulary.table.where(F.col("df") >= cut))
    if cut == 0 and tasks is None:
        return _all_weights(counted, shared, vocabulary.n_docs)
    dealt = _coded(counted, shared)
    if tasks is not None:
        # A join would deal anew what comes in fewer parts than it takes itself.
        parts = tasks if cut == 0 else max(tasks, _join_parts(counted.sparkSession))
        dealt = dealt.repartition(parts, "row_id")
    if cut == 0:
        whole = dealt.withColumn("found", _weights_of(F.col("rare"), vocabulary))
    else:
        whole = dealt.join(_rare_weights(dealt, vocabulary, cut), "row_id", "left")
    # Parts are put together as they are, so rows of an id stay together.
    whole = whole if tasks is None else whole.coalesce(tasks)
    return _decoded(whole, shared, vocabulary.n_docs).select("row_id", *keep, "terms", "weights")


def _join_parts(spark) -> int:
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    return max(int(spark.conf.get(name, None) or 0) for name in names)


def _weights_of(rare: Column, vocabulary: Vocabulary) -> Column:
    """``array<struct<term, w>>`` of counts of terms that are not in the vocabulary."""
    unknown = F.log(F.lit(float(vocabulary.n_docs + 1)))
    return F.transform(rare, lambda c: F.struct(c["term"].alias("term"), (c["tf"] * unknown).alias("w")))


def _rare_weights(coded: DataFrame, vocabulary: Vocabulary, cut: int) -> DataFrame:
    """``row_id, found``: weights of the terms that were not broadcast, by a join on the term."""
    schema = T.StructType([coded.schema["row_id"], *_COUNT.fields])

    def run(batches):
        for batch in batches:
            entries = pc.list_flatten(batch.column("rare"))
            owner = pc.list_parent_indices(batch.column("rare"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id").take(owner), entries.field("term"), entries.field("tf")],
                names=schema.names,
            )

    # All columns are taken, so that the shuffle of the rows is the one that they are read from.
    postings = coded.mapInArrow(run, schema)
    rare = vocabulary.table.where(F.col("df") < cut)
    df = F.coalesce("df", F.lit(0))
    weight = F.col("tf") * F.log(F.lit(float(vocabulary.n_docs + 1)) / (df + 1))
    return (
        postings.join(rare, "term", "left")
        .groupBy("row_id")
        .agg(F.sort_array(F.collect_list(F.struct("term", weight.alias("w")))).alias("found"))
    )
