"""Order statistics of one numeric column without sending the column through one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Number of value ranges that are accumulated in parallel, and the accuracy of their bounds: a range
# is off by one part in so many of all distinct values.
N_RANGES = 1024
BOUNDS_ACCURACY = 20_000


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """(value, n): how often each non-null value occurs."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(value).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def rows_before(counts: DataFrame) -> DataFrame:
    """Add ``before``: the number of rows with a smaller value, from (value, n).

    The distinct values are cut at their approximate quantiles into ranges of nearly equal length,
    however they are distributed. Each range is accumulated by its own task, and only the
    totals of the at most ``N_RANGES`` ranges are accumulated together.
    """
    bounds = counts.agg(range_bounds("value")).scalar()
    ranged = counts.withColumn("_bounds", bounds).select(
        "value", "n", _range_of(F.col("value").cast("double"), F.col("_bounds")).alias("_range")
    )

    earlier_ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.sum("n").alias("_total"))
        .select("_range", F.coalesce(F.sum("_total").over(earlier_ranges), F.lit(0)).alias("_offset"))
    )
    within = (
        Window.partitionBy("_range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranged.withColumn("_within", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(F.broadcast(offsets), "_range")
        .select("value", "n", (F.col("_within") + F.col("_offset")).alias("before"))
    )


def range_bounds(value: str) -> Column:
    """The values at which the column is cut into ranges, in ascending order."""
    shares = [i / N_RANGES for i in range(1, N_RANGES)]
    return F.percentile_approx(F.col(value).cast("double"), shares, BOUNDS_ACCURACY)


def _range_of(value: Column, bounds: Column) -> Column:
    """How many bounds are at or below the value, by binary search."""
    steps = F.array(*(F.lit(1 << i) for i in reversed(range((N_RANGES - 1).bit_length()))))

    def narrow(found: Column, step: Column) -> Column:
        there = found + step
        below = (there < N_RANGES) & (F.get(bounds, there - 1) <= value)
        return F.when(below, there).otherwise(found)

    return F.aggregate(steps, F.lit(0), narrow)


def exact_quantiles(df: DataFrame, value: str, names: Mapping[str, float]) -> DataFrame:
    """One row of exact quantiles with linear interpolation, named by ``names``."""
    return quantiles_of_counts(value_counts(df, value), names)


def quantiles_of_counts(counts: DataFrame, names: Mapping[str, float]) -> DataFrame:
    """The same from (value, n)."""
    last = counts.agg(F.sum("n") - 1).scalar()
    ranked = rows_before(counts).withColumn("_last", last)

    def at(position: Column) -> Column:
        hit = (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
        return F.max(F.when(hit, F.col("value").cast("double")))

    def interpolated(share: float) -> Column:
        position = F.col("_last") * F.lit(float(share))
        lower, upper = at(F.floor(position)), at(F.ceil(position))
        return lower + (upper - lower) * F.max(position - F.floor(position))

    return ranked.agg(*(interpolated(share).alias(name) for name, share in names.items()))


def average_ranks(counts: DataFrame) -> DataFrame:
    """(value, rank): the mean 1-based position of the rows that share a value."""
    return rows_before(counts).select("value", (F.col("before") + (F.col("n") + 1) / 2).alias("rank"))
