"""Ranking metrics over tables of recommendations and relevant products."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A rating from here on marks a relevant product, and the cut-off of the metrics.
RELEVANT_RATING = 4.0
CUT_OFF = 10

# Gains and metrics are added as decimals with so many digits after the point, and a mean is rounded
# to so many: sums of decimals do not depend on the order in which the rows arrive.
SUM_DIGITS = 15
MEAN_DIGITS = 12


def relevant_products(ratings: DataFrame) -> DataFrame:
    """Distinct (user_id, product_id) with a rating of at least 4."""
    return (
        ratings.where(F.col("rating") >= RELEVANT_RATING).select("user_id", "product_id").distinct()
    )


def relevant_lists(ratings: DataFrame) -> DataFrame:
    """(user_id, products): the relevant products of each user as a sorted array."""
    return (
        relevant_products(ratings)
        .groupBy("user_id")
        .agg(F.sort_array(F.collect_set("product_id")).alias("products"))
    )


def hits(recommended: DataFrame, relevant: DataFrame) -> DataFrame:
    """``recommended`` with a column ``hit``: 1 if the product is relevant to the user, else 0."""
    marked = relevant.select("user_id", "product_id").distinct().withColumn("hit", F.lit(1))
    return recommended.join(marked, ["user_id", "product_id"], "left").fillna(0, ["hit"])


def user_metrics(
    recommended: DataFrame,
    relevant: DataFrame,
    k: int = CUT_OFF,
    users: DataFrame | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """(user_id, precision, recall, ndcg, mrr) per user.

    ``recommended`` is (user_id, product_id, rank) with ranks from 1. Users are those with a
    relevant product unless a table is given; who has no hits scores 0. ``by`` names further
    columns of ``recommended`` and ``users`` that separate several lists per user.
    """
    keys = ["user_id", *by]
    marked = hits(recommended.select(*keys, "product_id", "rank"), relevant)
    in_cut = F.col("rank") <= k
    gain = F.col("hit") / F.log2(F.col("rank") + 1)
    found = marked.where("hit = 1").groupBy(*keys).agg(
        F.sum(F.when(in_cut, F.col("hit")).otherwise(0)).alias("n_hits"),
        F.sum(_fixed(F.when(in_cut, gain).otherwise(0.0))).cast("double").alias("gain"),
        F.max(F.col("hit") / F.col("rank")).alias("mrr"),
    )
    counts = relevant.groupBy("user_id").agg(F.count_distinct("product_id").alias("n_relevant"))
    best = ideal_gain(F.col("n_relevant"), k)
    judged = counts if users is None else users.join(counts, "user_id", "left")
    return (
        judged.join(found, keys, "left")
        .fillna(0, ["n_relevant", "n_hits", "gain", "mrr"])
        .select(
            *keys,
            (F.col("n_hits") / F.lit(float(k)) if k > 0 else F.lit(0.0)).alias("precision"),
            _ratio(F.col("n_hits"), F.col("n_relevant")).alias("recall"),
            _ratio(F.col("gain"), best).alias("ndcg"),
            "mrr",
        )
    )


def ideal_gain(n_relevant: Column, k: int) -> Column:
    """The gain of a list that begins with the user's relevant products."""
    ideal = [0.0]
    for rank in range(1, max(k, 0) + 1):
        ideal.append(ideal[-1] + 1 / math.log2(rank + 1))
    return F.array(*map(F.lit, ideal))[F.least(n_relevant, F.lit(max(k, 0))).cast("int")]


def _fixed(column: Column) -> Column:
    return column.cast(f"decimal({SUM_DIGITS + 5},{SUM_DIGITS})")


def fixed_mean(column: Column) -> Column:
    """The mean of figures below 100,000 that is the same in whatever order they are added."""
    total = F.sum(_fixed(column)).cast(f"decimal(38,{SUM_DIGITS})")
    mean = total / F.count(column).cast("decimal(20,0)")
    return F.round(mean, MEAN_DIGITS).cast("double")


def _ratio(part, whole):
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def mean_metrics(per_user: DataFrame) -> DataFrame:
    """One row with the four means, see :func:`fixed_mean`; zeros when there is no user."""
    return per_user.agg(
        *(
            F.coalesce(fixed_mean(F.col(column)), F.lit(0.0)).alias(name)
            for column, name in (
                ("precision", "precision_at_10"),
                ("recall", "recall_at_10"),
                ("ndcg", "ndcg_at_10"),
                ("mrr", "mrr"),
            )
        )
    )
