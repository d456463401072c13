"""Row-local array idioms. They replace shuffles where the data of one group
already sits in one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def runs(ordered: Column, key: Callable[[Column], Column]) -> Column:
    """Split a sorted array into an array of arrays of equal ``key``.

    Linear in the array length: only the run starts are kept and sliced.
    """

    def split(items: Column) -> Column:
        n = F.size(items)
        positions = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))

        def starts_here(p: Column) -> Column:
            changed = key(F.get(items, p)) != key(F.get(items, p - 1))
            return (p < n) & ((p == 0) | changed)

        def cut(starts: Column) -> Column:
            return F.transform(
                starts,
                lambda p, i: F.slice(items, p + 1, F.coalesce(F.get(starts, i + 1), n) - p),
            )

        return let(F.filter(positions, starts_here), cut)

    return let(ordered, split)


def counts(items: Column) -> Column:
    """``array<struct<term, tf>>`` of an array of strings, sorted by term."""

    def count(ordered: Column) -> Column:
        n = F.size(ordered)
        positions = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))

        def starts_here(p: Column) -> Column:
            return (p < n) & ((p == 0) | (F.get(ordered, p) != F.get(ordered, p - 1)))

        def tally(starts: Column) -> Column:
            return F.transform(
                starts,
                lambda p, i: F.struct(
                    F.get(ordered, p).alias("term"),
                    (F.coalesce(F.get(starts, i + 1), n) - p).alias("tf"),
                ),
            )

        return let(F.filter(positions, starts_here), tally)

    return let(F.sort_array(items), count)
