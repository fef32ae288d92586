"""Cleaning steps for raw reviews: ordered de-duplication, null and rating checks, cold start."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tallyrec.functions.columns import to_number
from tallyrec.session import materialize

KEY_COLUMNS = ("user_id", "product_id")

# Tables of the counts of a key are put together in one once there are so many.
MAX_PARTS = 8


def remove_duplicates(
    df: DataFrame, subset: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """Keep the first row, by ``order_by``, of every distinct ``subset``; nulls compare equal.

    Spark limits each group to one row before the shuffle, so a key that holds a large share of
    the rows sends at most one row per input partition to its reducer.
    """
    first = Window.partitionBy(*subset).orderBy(*order_by)
    return (
        df.withColumn("_position", F.row_number().over(first))
        .where("_position = 1")
        .drop("_position")
    )


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``columns``."""
    return df.na.drop(subset=list(columns))


def keep_valid_ratings(df: DataFrame) -> DataFrame:
    """Coerce the rating to double and keep 1 <= rating <= 5."""
    return df.withColumn("rating", to_number(df, "rating")).where(F.col("rating").between(1, 5))


def keep_members(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` occurs in ``ids``."""
    return df.join(ids.select(key), key, "left_semi")


class ColdStart(NamedTuple):
    """Result of :func:`filter_cold_start`. The counters count rows, not users or products."""

    interactions: DataFrame
    user_rows_dropped: int
    product_rows_dropped: int
    rows_per_pass: list[int]  # at the start of each pass


def filter_cold_start(
    df: DataFrame, min_user_reviews: int = 5, min_product_reviews: int = 10
) -> ColdStart:
    """Drop users, then products, below their threshold until a pass drops nothing.

    The loop needs the distinct (user, product) pairs with their row counts, and per key how many
    rows every id has left. A half pass is one job: it takes what the ids that just fell out on the
    other side had from the ids of this side, writes the new counts of those alone, and observes on
    the way how many fell below the threshold and how many rows went with them. Pairs are never
    rewritten; a pair is left as long as both its ids are. Spark knows the size of every table and
    broadcasts it only while it is small. The rows themselves are filtered once, at the end.
    """
    thresholds = {"user_id": min_user_reviews, "product_id": min_product_reviews}
    other_key = {"user_id": "product_id", "product_id": "user_id"}
    pairs = materialize(
        df.groupBy(*KEY_COLUMNS).agg(F.count(F.lit(1)).alias("n_rows")), "pairs"
    )
    left = {key: _Left(pairs, key, threshold) for key, threshold in thresholds.items()}
    dropped = dict.fromkeys(thresholds, 0)
    remaining = pairs.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    rows_per_pass = []

    unchecked = set(thresholds)  # keys whose counts may have changed since their last check
    while unchecked:
        rows_per_pass.append(remaining)
        for key in thresholds:
            if key not in unchecked:
                continue
            unchecked.discard(key)
            n_ids, n_rows = left[key].check(left[other_key[key]])
            if n_ids:
                dropped[key] += n_rows
                remaining -= n_rows
                unchecked.add(other_key[key])
    if remaining < rows_per_pass[-1]:
        rows_per_pass.append(remaining)

    kept = df
    for key in thresholds:
        if dropped[key]:
            # a missing id never reaches a threshold
            ids = left[key].alive().withColumnRenamed(key, "_id")
            kept = kept.join(ids, kept[key] == ids["_id"], "left_semi")
    return ColdStart(kept, dropped["user_id"], dropped["product_id"], rows_per_pass)


class _Left:
    """The rows that the ids of one key have left: written tables of (id, n, step), the latest of
    which counts. An id is out once its ``n`` is below the threshold, or if it is missing."""

    def __init__(self, pairs: DataFrame, key: str, threshold: int) -> None:
        self.pairs, self.key, self.threshold = pairs, key, threshold
        self.parts: list[DataFrame] = []
        self.fallen: DataFrame | None = None  # ids that fell out in the latest check
        self.step = 0

    def check(self, other: _Left) -> tuple[int, int]:
        """Take off what ``other`` lost in its latest check; how many ids fell out now, and rows.

        An id that fell out before is not counted again: it had fewer rows than the threshold.
        """
        if not self.parts:
            counts = self.pairs.groupBy(self.key).agg(F.sum("n_rows").alias("n"))
            if other.fallen is not None:
                counts = self._less(counts, other, "left")
        else:
            counts = self._less(self._current().where(self._is_in()), other, "inner")
        self.step += 1
        seen = Observation()
        out = ~self._is_in()
        ids, rows = F.count_if(out), F.sum(F.when(out, F.col("n")))
        counts = counts.observe(seen, ids.alias("ids"), rows.alias("rows"))
        written = materialize(counts.withColumn("step", F.lit(self.step)), f"{self.key}-left")
        if len(self.parts) >= MAX_PARTS:
            self.parts = [materialize(self._current(), f"{self.key}-left")]
        self.parts.append(written)
        self.fallen = written.where(out).select(self.key)
        return seen.get["ids"], seen.get["rows"] or 0

    def alive(self) -> DataFrame:
        return materialize(self._current().where(self._is_in()).select(self.key), f"{self.key}-alive")

    def _is_in(self) -> Column:
        return (F.col("n") >= self.threshold) & F.col(self.key).isNotNull()

    def _current(self) -> DataFrame:
        every = reduce(DataFrame.union, self.parts)
        if len(self.parts) == 1:
            return every
        return every.groupBy(self.key).agg(
            F.max_by("n", "step").alias("n"), F.max("step").alias("step")
        )

    def _less(self, counts: DataFrame, other: _Left, how: str) -> DataFrame:
        """(id, n) after the loss of the pairs whose other id has just fallen out."""
        ids = other.fallen.select(F.col(other.key).alias("_id"))
        lost = self.pairs.join(ids, self.pairs[other.key].eqNullSafe(ids["_id"]), "left_semi")
        lost = lost.groupBy(F.col(self.key).alias("_lost")).agg(F.sum("n_rows").alias("less"))
        joined = counts.join(lost, counts[self.key].eqNullSafe(lost["_lost"]), how)
        n = F.col("n") - F.coalesce("less", F.lit(0))
        return joined.select(self.key, n.alias("n"))
