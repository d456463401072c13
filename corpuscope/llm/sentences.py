"""Repeated runs of sentences: sliding spans, hashed and met globally.

A sentence ends at ``.``, ``!``, ``?`` or the end of a line; its white space counts as one
blank. Every RUN consecutive sentences that have MIN_WORDS words together are a span. Of
equal spans in all documents the first, by id and place, stays; each sentence that any
other of them covers is removed.

Only hashes are counted over all spans. What occurs once leaves there, and the rest is
told apart by 128 bits. Groups of any size are met by partial aggregation and a join with
the stored table of their first places, which adaptive execution can split.

Cases: null text is empty; texts without a span keep all; repeated rows are one document
written several times and lose the same sentences; rows are told apart by 128 bits of
hash over id and text, so ids may repeat or be null; rows without an id come first, rows
of one id are in the order of that hash; a text is split whole in one task, however long; an
empty table gives no rows; columns besides id and text are not looked at.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import id_back, marked, stored
from corpuscope.llm.substrings import batch_of

RUN = 2
MIN_WORDS = 10
ROW = ("doc", "mark", "twin")
PIECE = re.compile(rb"[^.!?\n]*[.!?\n]+|[^.!?\n]+")


def sentences(text: bytes) -> list[tuple[int, list[bytes]]]:
    """(piece, words) of the pieces of a text that have words."""
    found = ((k, p.split()) for k, p in enumerate(PIECE.findall(text)))
    return [(k, words) for k, words in found if words]


def spans_of(text: bytes, run: int, min_words: int) -> list[tuple[int, int, int]]:
    """(place of the first sentence, two halves of the hash) of each span."""
    have = [words for _, words in sentences(text)]
    joined = [b" ".join(words) for words in have]
    out = []
    for k in range(len(have) - run + 1):
        if sum(map(len, have[k : k + run])) >= min_words:
            digest = xxhash.xxh3_128_digest(b" ".join(joined[k : k + run]))
            out.append((k, *(int.from_bytes(digest[i : i + 8], "big", signed=True) for i in (0, 8))))
    return out


def scan(docs: DataFrame, run: int, min_words: int) -> DataFrame:
    kinds = {"doc": "int64", "mark": "int64", "twin": "int64", "place": "int32", "key": "int64", "check": "int64"}

    def spans(batches):
        for batch in batches:
            rows = []
            keys = zip(*(batch.column(k).to_pylist() for k in range(3)))
            for key, text in zip(keys, batch.column(3)):
                rows += [(*key, *s) for s in spans_of(text.as_py().encode(), run, min_words)]
                if len(rows) > 50_000:
                    yield batch_of(rows, kinds)
                    rows = []
            if rows:
                yield batch_of(rows, kinds)

    return marked(docs).select(*ROW, "text").mapInArrow(
        spans, "doc long, mark long, twin long, place int, key long, check long"
    )


def repeated(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, mark, twin, places, sources): starts of non-first spans, ids of the first ones."""
    spans = scan(docs, run, min_words)
    shared = stored(
        spans.groupBy("key").count().where("count > 1").select("key"), "sentence-keys"
    )
    left = stored(spans.join(shared, "key"), "sentence-spans")
    first = stored(
        left.groupBy("key", "check")
        .agg(F.min(F.struct(*ROW, "place")).alias("first"), F.count("*").alias("n"))
        .where("n > 1"),
        "sentence-first",
    )
    later = left.join(first, ["key", "check"]).where(F.struct(*ROW, "place") != F.col("first"))
    return stored(
        later.groupBy(*ROW).agg(
            F.sort_array(F.collect_set("place")).alias("places"),
            F.sort_array(F.collect_set(id_back("first.doc", "source"))).alias("sources"),
        ),
        "sentence-places",
    )


def remove(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: doc, n_sentences, n_removed, n_spans (removed runs), sources, kept (text)."""
    places = repeated(docs, run, min_words)
    joined = marked(docs).join(places, list(ROW), "left").select(
        "doc", "text", "places", "sources"
    )
    kinds = {"doc": "int64", "n_sentences": "int64", "n_removed": "int64", "n_spans": "int64"}

    def rebuild(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                out, kept = [], []
                for doc, text, places in zip(*(part.column(k).to_pylist() for k in range(3))):
                    data = text.encode()
                    have = sentences(data)
                    gone = sorted({p + k for p in places or () for k in range(run)})
                    if gone:
                        dropped = {have[k][0] for k in gone}
                        pieces = PIECE.findall(data)
                        data = b"".join(p for k, p in enumerate(pieces) if k not in dropped)
                    starts = len(set(gone) - {k + 1 for k in gone})
                    out.append((doc, len(have), len(gone), starts))
                    kept.append(data.decode())
                rows = batch_of(out, kinds)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, part.column(3), pa.array(kept, pa.string())],
                    names=[*kinds, "sources", "kept"],
                )

    return joined.mapInArrow(
        rebuild,
        "doc long, n_sentences long, n_removed long, n_spans long, sources array<long>, kept string",
    )


def report(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    return remove(docs, run, min_words).select(
        id_back(),
        "n_sentences",
        "n_removed",
        "n_spans",
        F.array_min("sources").alias("copied_from"),
        F.octet_length("kept").cast("long").alias("kept_bytes"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


SQL = r"""
    WITH pieces AS (
        SELECT doc_id, unnest(x) AS piece, generate_subscripts(x, 1) AS i
        FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?\n]*[.!?\n]+|[^.!?\n]+')
            AS x FROM documents)),
    cleaned AS (
        SELECT *, trim(regexp_replace(piece, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS words FROM pieces),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS place FROM cleaned
        WHERE words <> ''),
    runs AS (
        SELECT doc_id, place, words || ' ' || lead(words) OVER (PARTITION BY doc_id ORDER BY place)
            AS run FROM placed),
    spans AS (
        SELECT doc_id, place, row_number() OVER w AS k, first_value(doc_id) OVER w AS source
        FROM runs WHERE length(run) - length(replace(run, ' ', '')) >= 9
        WINDOW w AS (PARTITION BY run ORDER BY doc_id, place)),
    later AS (SELECT * FROM spans WHERE k > 1),
    gone AS (
        SELECT DISTINCT doc_id, place + step AS place FROM later, (VALUES (0), (1)) AS t(step)),
    marked AS (
        SELECT p.doc_id, p.i, p.place, g.place IS NOT NULL AS away,
            lag(g.place) OVER (PARTITION BY p.doc_id ORDER BY p.place) IS NOT NULL AS before
        FROM placed p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.place = p.place),
    counted AS (
        SELECT doc_id, count(*) AS n_sentences, count(*) FILTER (away) AS n_removed,
            count(*) FILTER (away AND NOT before) AS n_spans
        FROM marked GROUP BY doc_id),
    kept AS (
        SELECT p.doc_id, coalesce(string_agg(p.piece, '' ORDER BY p.i)
            FILTER (m.away IS NOT TRUE), '') AS text
        FROM pieces p LEFT JOIN marked m ON m.doc_id = p.doc_id AND m.i = p.i GROUP BY p.doc_id),
    origin AS (SELECT doc_id, min(source) AS s FROM later GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(n_removed, 0) AS n_removed,
        coalesce(n_spans, 0) AS n_spans, s AS copied_from,
        strlen(coalesce(k.text, '')) AS kept_bytes, sha256(coalesce(k.text, '')) AS kept_sha256
    FROM documents d LEFT JOIN counted c ON c.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
        LEFT JOIN origin o ON o.doc_id = d.doc_id"""
