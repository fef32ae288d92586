"""Column expressions for splitting a key into ranges, evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def range_of(key: Column, splitters: Sequence[int]) -> Column:
    """How many of the ascending ``splitters`` are at or below ``key``, by binary search."""
    if not splitters:
        return F.lit(0)
    n = len(splitters)
    steps = [1 << i for i in reversed(range(n.bit_length()))]
    bounds = F.array(*[F.lit(s).cast("long") for s in splitters])

    def narrow(found: Column, step: Column) -> Column:
        there = found + step
        return F.when(there > n, found).when(F.get(bounds, there - 1) <= key, there).otherwise(found)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), narrow)
