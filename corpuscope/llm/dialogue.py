"""Turns of conversations gathered in order, one row per conversation.

Order of turns: turn number (nulls first), role, text. Conversations of up to MANY rows are
gathered by one exchange. The rows of a longer one are dealt out by ranges of that order,
each range is gathered and handed to ``partial`` in a task of its own, and only
these partial results meet in the conversation's row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import stored
from corpuscope.session import materialize_for_join

MANY = 4096
BROADCAST_ROWS = 500_000
#: Characters of a text that decide on its range, so that bounds of ranges stay short.
PREFIX = 32


def gather(
    rows: DataFrame, partial: Callable[[Column], Column], many: int = MANY
) -> DataFrame:
    """(conv, parts): ``partial`` of the sorted turns, or of each range of them in order.

    ``rows`` has conv, turn, role, text; conv, role and text are not null. ``partial``
    takes and returns an array; ``parts`` holds all results as one array.
    """
    turn = F.struct("turn", "role", "text")
    ordered = F.sort_array(F.collect_list(turn))
    long = rows.groupBy("conv").count().where(F.col("count") > many)
    long = materialize_for_join(long, BROADCAST_ROWS)
    if long.isEmpty():
        return rows.groupBy("conv").agg(ordered.alias("turns")).select(
            "conv", partial(F.col("turns")).alias("parts")
        )
    short = rows.join(long, "conv", "left_anti").groupBy("conv").agg(ordered.alias("turns"))
    ranges = (long.agg(F.sum("count")).first()[0] // many) + 1
    pieces = (
        rows.join(long, "conv", "left_semi")
        .repartitionByRange(ranges, "conv", "turn", "role", F.substring("text", 1, PREFIX))
        .groupBy("conv", F.spark_partition_id().alias("piece"))
        .agg(ordered.alias("turns"))
        .select("conv", "piece", partial(F.col("turns")).alias("parts"))
    )
    whole = (
        stored(pieces, "dialogue-pieces")
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct("piece", "parts"))).alias("pieces"))
        .select("conv", F.flatten(F.col("pieces.parts")).alias("parts"))
    )
    return short.select("conv", partial(F.col("turns")).alias("parts")).unionByName(whole)
