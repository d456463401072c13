"""SimHash near-duplicates: pigeonring filtering before the Hamming check.

Cut two fingerprints into ``m`` segments that form a ring. If they differ in at most
``t`` bits, there is a segment from which every chain of ``l`` consecutive segments
differs in at most ``l * t / m`` bits. The longest chain whose budget is below one bit
must be equal: that is the join key. The longer chains prune what the key lets
through, and only then are all bits counted.

Cases: null text is empty; no words give fingerprint zero; fewer words than a shingle
give one shingle of all words; repeated rows and equal fingerprints are one node;
a null id takes part in a group, but never names one that has another id; a text is
hashed whole in one task, however long. Columns besides id and text are not looked at.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import (
    NULL_ID,
    connected_components,
    id_back,
    in_tasks,
    marked,
    stored,
    texts,
    without,
)

SEGMENTS = 16
BUCKET = 256
BROADCAST_ROWS = 500_000
#: Eight byte lanes for each byte: lane j counts bit j, highest first.
LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view("<u8").ravel()


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the rows of bytes (n, width) have each bit set."""
    sums = np.add.reduceat(LANES[hashes], np.arange(0, len(hashes), 255), axis=0)
    return sums.view(np.uint8).reshape(len(sums), -1).sum(axis=0, dtype=np.int64)


def majority(hashes: np.ndarray) -> np.ndarray:
    """Bits set in over half of the rows of bytes (n, width), packed."""
    return np.packbits(2 * bit_counts(hashes) > len(hashes))


def shingle_hashes(text: str, words: int, seed: int) -> list[int]:
    found = text.encode().lower().split()
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(found), seed)] if found else []
    joined = b" ".join(found)
    ends = list(accumulate(len(w) + 1 for w in found))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s : e - 1], seed) for s, e in zip([0, *ends], ends[words - 1 :])]


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """64 bits, as a signed integer."""
    hashes = shingle_hashes(text, words, seed)
    if not hashes:
        return 0
    packed = majority(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8))
    return int.from_bytes(packed.tobytes(), "big", signed=True)


def fingerprints(rows: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """The columns of ``rows``, all long, with ``fp`` in the place of ``text``."""
    keys = [c for c in rows.columns if c != "text"]

    def run(batches):
        for batch in batches:
            found = [fingerprint(t, words, seed) for t in batch.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keys)], pa.array(found, pa.int64())], names=[*keys, "fp"]
            )

    schema = ", ".join(f"{c} long" for c in [*keys, "fp"])
    return in_tasks(rows.select(*keys, "text"), run, schema)


def ring(bits: int, segments: int, differing: int) -> tuple[int, list[tuple[int, int]]]:
    """Bits of the equal chain; then (bits of a chain, differences it may have)."""
    width = bits // segments
    budget = [n * differing // segments for n in range(segments + 1)]
    last = {b: n for n, b in enumerate(budget)}
    return last[0] * width, [(n * width, b) for b, n in last.items() if b]


def links(nodes: DataFrame, differing: int = 2, segments: int = SEGMENTS) -> DataFrame:
    """(a, b): enough links to connect all nodes ``fp`` that differ in few bits.

    Up to BUCKET fingerprints that share a chain are compared with each other. A
    fuller bucket is linked exactly in linear work: two fingerprints differ in at most
    two bits if and only if flipping at most one bit in each makes them equal, so those
    that share such a neighbour are linked to the smallest of them.
    """
    if differing != 2 or 64 % segments or segments <= differing:
        raise ValueError("two differing bits, and more segments than that, which divide 64")
    equal, chains = ring(64, segments, differing)
    width = 64 // segments
    turned = [
        F.shiftleft("fp", i * width).bitwiseOR(F.shiftrightunsigned("fp", 64 - i * width))
        if i
        else F.col("fp")
        for i in range(segments)
    ]
    rows = nodes.select(
        F.posexplode(F.array(*turned)).alias("i", "fp")
    ).select(
        F.shiftleft(F.col("i").cast("long"), equal)
        .bitwiseOR(F.shiftrightunsigned("fp", 64 - equal))
        .alias("key"),
        F.col("fp"),
        F.col("i"),
    )
    counted = stored(rows.groupBy("key").count().where("count > 1"), "simhash-keys")
    rows = stored(rows.join(counted, "key"), "simhash-buckets")
    few = rows.where(F.col("count") <= BUCKET)
    left, right = few.alias("l"), few.select("key", F.col("fp").alias("other")).alias("r")
    apart = F.col("fp").bitwiseXOR(F.col("other"))
    near = [
        F.bit_count(F.shiftrightunsigned(apart, 64 - n) if n < 64 else apart) <= b
        for n, b in chains
    ]
    condition = (F.col("l.key") == F.col("r.key")) & (F.col("fp") < F.col("other"))
    for chain in near:
        condition = condition & chain
    back = lambda c: F.when(F.col("i") == 0, F.col(c)).otherwise(
        F.expr(f"shiftrightunsigned({c}, i * {width}) | shiftleft({c}, 64 - i * {width})")
    )
    pairs = left.join(right, condition).select(back("fp").alias("a"), back("other").alias("b"))
    flips = F.array(
        F.col("fp"),
        *(F.col("fp").bitwiseXOR(F.lit(1 << n)) for n in range(64 - equal)),
    )
    flipped = rows.where(F.col("count") > BUCKET).select(
        "i", "fp", F.explode(flips).alias("neighbour")
    )
    least = stored(
        flipped.groupBy("i", "neighbour")
        .agg(F.min("fp").alias("other"), F.count("*").alias("n"))
        .where("n > 1"),
        "simhash-neighbours",
    )
    stars = flipped.join(least, ["i", "neighbour"]).where("fp <> other").select(
        back("fp").alias("a"), back("other").alias("b")
    )
    return pairs.union(stars).distinct()


def rooted(nodes: DataFrame, differing: int) -> DataFrame:
    """The columns of ``nodes`` with ``root``, a fingerprint that names the component."""
    found = connected_components(links(nodes, differing))
    return nodes.join(found, nodes.fp == found.node, "left").select(
        *nodes.columns, F.coalesce("root", "fp").alias("root")
    )


def components(docs: DataFrame, words: int = 3, seed: int = 42, differing: int = 2) -> DataFrame:
    """Per row: doc_id, fingerprint, component_id (smallest id its links lead to)."""
    rows = stored(fingerprints(texts(docs), words, seed), "simhash-fingerprints")
    real = F.when(F.col("doc") != NULL_ID, F.col("doc"))
    nodes = stored(rows.groupBy("fp").agg(F.min(real).alias("least")), "simhash-nodes")
    with_root = rooted(nodes, differing)
    least = with_root.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = with_root.join(least, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        id_back(), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame, words: int = 3, seed: int = 42, differing: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each component, that with the
    smallest id (null last; of equal ids the smallest hash of the row)."""
    rows = stored(fingerprints(marked(docs), words, seed), "simhash-rows")
    one = F.struct((F.col("doc") == NULL_ID).alias("missing"), "doc", "mark", "twin")
    nodes = stored(rows.groupBy("fp").agg(F.min(one).alias("least")), "simhash-nodes")
    roots = stored(rooted(nodes, differing), "simhash-roots")
    first = stored(roots.groupBy("root").agg(F.min("least").alias("first")), "simhash-first")
    stays = stored(roots.join(first, "root").select("fp", "first"), "simhash-stays")
    decided = rows.join(stays, "fp")
    here = (F.col("mark") == F.col("first.mark")) & (F.col("twin") == F.col("first.twin"))
    gone = decided.where(~here).select("mark", "twin").distinct()
    twice = decided.where(here).groupBy("mark", "twin").count().where("count > 1").drop("count")
    return without(docs, gone, twice, BROADCAST_ROWS)
