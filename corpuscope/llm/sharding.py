"""Shards of nearly equal bytes, in DataFrame operations only.

Unit of the cut is a group of equal texts; its rows share a shard. A group larger than a
shard's share cannot, and is broken by hash of the row into parts. Units above a 64th of a
share, 64 x shards at most, are placed first, largest into the emptiest shard. All other
units stand in one global order, by first document: totals per partition give each
partition's offset, a running sum inside it the rest, and the line is cut where the room
left in the shards ends. So a shard is a contiguous stretch of that order.

Cases: null text has no bytes and equals the empty text; rows without an id come first;
repeated rows are rows of one group; an empty table gives no rows; columns besides id and
text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpuscope.llm.common import id_back, id_key, stored, text_of

FINE = 64


def place(units: list[tuple[int, str, int]], shards: int) -> tuple[list, list[int]]:
    """(bytes, digest, part) in turn into the emptiest shard, largest first."""
    load, placed = [0] * shards, []
    for size, digest, part in sorted(units, reverse=True):
        shard = min(range(shards), key=lambda k: (load[k], k))
        load[shard] += size
        placed.append((digest, part, shard))
    return placed, load


def running(df: DataFrame, size: str, order: list[str], name: str) -> DataFrame:
    """Adds ``before``: the sum of ``size`` over all rows in front, in the global order."""
    ranged = stored(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name
    )
    totals = ranged.groupBy("_part").agg(F.sum(size).alias("_total"))
    # One row per partition.
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_ahead")
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        ranged.withColumn("before", F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .join(offsets, "_part")
        .withColumn("before", F.col("before") + F.col("_ahead"))
        .drop("_part", "_ahead")
    )


def assign(
    docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: doc, size, text_crc32, shard, slot."""
    spark = docs.sparkSession
    text = text_of(text_column)
    rows = stored(
        docs.select(
            id_key(id_column).alias("doc"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = max(1, total / shards)
    # At most as many groups as shards are larger than a share.
    large = (
        rows.groupBy("digest")
        .agg(F.sum("size").alias("bytes"))
        .where(F.col("bytes") > share)
        .select("digest", F.ceil(F.col("bytes") * 2 * FINE / share).alias("parts"))
    )
    rows = stored(
        rows.join(F.broadcast(large), "digest", "left").withColumn(
            "part",
            F.coalesce(F.expr("pmod(xxhash64(doc, row), parts)"), F.lit(0)).cast("long"),
        ).drop("parts"),
        "shard-parts",
    )
    units = stored(
        rows.groupBy("digest", "part").agg(
            F.sum("size").alias("bytes"), F.min("doc").alias("first")
        ),
        "shard-units",
    )
    big = F.col("bytes") > share / FINE
    placed, load = place(
        [tuple(r) for r in units.where(big).select("bytes", "digest", "part").collect()], shards
    )
    room = [max(0.0, share - n) for n in load]
    scale = (total - sum(load)) / (sum(room) or 1)
    cuts, at = [], 0.0
    for r in room[:-1]:
        at += r * scale
        cuts.append(at)
    order = ["first", "digest", "part"]
    line = running(units.where(~big), "bytes", order, "shard-line")
    middle = F.col("before") + F.col("bytes") / 2
    shard = sum(((middle >= cut).cast("int") for cut in cuts), F.lit(0))
    homes = line.select("digest", "part", shard.alias("shard"))
    if placed:
        values = ", ".join(f"('{d}', {p}L, {s})" for d, p, s in placed)
        homes = homes.union(spark.sql(f"SELECT * FROM VALUES {values} AS t(digest, part, shard)"))
    homed = rows.join(homes, ["digest", "part"]).select(
        "doc", "size", "text_crc32", "shard", "row"
    )
    ranged = stored(
        homed.repartitionByRange("shard", "doc", "row").withColumn(
            "_part", F.spark_partition_id()
        ),
        "shard-slots",
    )
    counts = ranged.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("shard").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        "shard", "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead")
    )
    inside = Window.partitionBy("_part", "shard").orderBy("doc", "row")
    return (
        ranged.withColumn("_at", F.row_number().over(inside) - 1)
        .join(offsets, ["shard", "_part"])
        .select(
            "doc", "size", "text_crc32", "shard", (F.col("_at") + F.col("_ahead")).alias("slot")
        )
    )


def report(docs: DataFrame, shards: int = 16) -> DataFrame:
    return assign(docs, shards).select(
        id_back(),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
