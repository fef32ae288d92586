"""Descriptive statistics of interactions, products and users.

Every function returns a small DataFrame: one row of figures, or the table behind a chart. The
``..._figures`` functions start from aggregates, so that several analyses can share them.
One-row results are attached to others as scalar subqueries, never by a cross join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrec.functions.columns import density, share_bar, sparsity, unix_timestamp_to_month
from tallyrec.operators.cleaning import KEY_COLUMNS
from tallyrec.operators.distribution import average_ranks, quantiles_of_counts, value_counts
from tallyrec.operators.tables import sparsity_counts

# The quantiles reported for activity, and the whole stars of the rating scale.
ACTIVITY_QUANTILES = {"p25": 0.25, "p75": 0.75, "p95": 0.95, "p99": 0.99}
STARS = (1, 2, 3, 4, 5)

# Fixed value: whiskers reach the furthest point within this many interquartile ranges.
WHISKER_RANGE = 1.5


# --- ratings -------------------------------------------------------------------------------


def rating_distribution(interactions: DataFrame) -> DataFrame:
    """One row: mean, median, std, min, max, the share of each whole star, and ``shares``: an array
    of (value, share) for every rating that occurs, in ascending order."""
    return rating_figures(value_counts(interactions, "rating"))


def rating_figures(counts: DataFrame) -> DataFrame:
    """The same from (value, n) per distinct rating."""
    value, n = F.col("value").cast("double"), F.col("n")
    total = F.sum(n)
    mean = counts.agg(F.sum(value * n) / F.nullif(total, F.lit(0))).scalar()
    # deviations from the mean first: the difference of two large sums would lose digits
    squares = F.sum((value - F.col("_mean")) * (value - F.col("_mean")) * n)
    stars = [
        (F.sum(F.when(F.floor(value) == star, n).otherwise(0)) / total).alias(f"pct_{star}")
        for star in STARS
    ]
    figures = counts.withColumn("_mean", mean).agg(
        total.alias("total"),
        F.max("_mean").alias("mean"),
        F.sqrt(squares / F.nullif(total - 1, F.lit(0))).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        *stars,
        F.array_sort(F.collect_list(F.struct(value.alias("value"), n.alias("share")))).alias("shares"),
    )
    share = F.transform(
        "shares",
        lambda item: F.struct(
            item["value"].alias("value"), (item["share"] / F.col("total")).alias("share")
        ),
    )
    median = quantiles_of_counts(counts, {"median": 0.5}).scalar()
    return figures.where("total > 0").select(
        "mean",
        median.alias("median"),
        "std",
        "min",
        "max",
        *(f"pct_{star}" for star in STARS),
        share.alias("shares"),
    )


def rating_frequencies(interactions: DataFrame) -> DataFrame:
    """(rating, n, share, bar) per distinct rating."""
    counts = value_counts(interactions, "rating")
    total = counts.agg(F.sum("n")).scalar()
    shares = counts.select(F.col("value").alias("rating"), "n", (F.col("n") / total).alias("share"))
    return shares.withColumn("bar", share_bar(F.col("share"))).orderBy("rating")


# --- activity per user or product ----------------------------------------------------------


def activity_counts(interactions: DataFrame, key: str) -> DataFrame:
    """(key, n): non-null ratings per user or product."""
    return (
        interactions.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("rating").alias("n"))
    )


def activity_summary(interactions: DataFrame, key: str) -> DataFrame:
    """One row about the ratings per ``key``: mean, median, std, min, max, p25, p75, p95, p99."""
    return activity_figures(activity_counts(interactions, key))


def activity_figures(counts: DataFrame) -> DataFrame:
    """The same from (key, n).

    The exact percentile buffers hold distinct counts only. d distinct counts need at least
    d * (d + 1) / 2 interactions, so the buffers grow with the square root of the data.
    """
    quantiles = {"median": 0.5, **ACTIVITY_QUANTILES}
    figures = counts.agg(
        F.avg("n").alias("mean"),
        F.stddev_samp("n").alias("std"),
        F.min("n").cast("double").alias("min"),
        F.max("n").cast("double").alias("max"),
        F.percentile("n", list(quantiles.values())).alias("q"),
    )
    return figures.select(
        "mean", "std", "min", "max", *(F.col("q")[i].alias(q) for i, q in enumerate(quantiles))
    )


def user_activity(interactions: DataFrame) -> DataFrame:
    return activity_summary(interactions, "user_id")


def product_activity(interactions: DataFrame) -> DataFrame:
    return activity_summary(interactions, "product_id")


def activity_histogram(interactions: DataFrame, key: str, bins: int = 50) -> DataFrame:
    """(bin, low, high, n): equal-width bins over the range of counts, the last one closed."""
    counts = activity_counts(interactions, key)
    span = counts.agg(F.min("n").alias("low"), F.max("n").alias("high")).where("low is not null")
    margin = F.when(F.col("low") == F.col("high"), 0.5).otherwise(0.0)
    ends = F.struct((F.col("low") - margin).alias("low"), (F.col("high") + margin).alias("high"))
    span = span.select(ends).scalar()
    low, width = F.col("_span.low"), F.col("_span.high") - F.col("_span.low")

    position = F.floor((F.col("n") - low) * bins / width)
    filled = (
        counts.withColumn("_span", span)
        .groupBy(F.least(position, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = interactions.sparkSession.range(bins).withColumn("_span", span).select(
        F.col("id").alias("bin"),
        (low + width * F.col("id") / bins).alias("low"),
        (low + width * (F.col("id") + 1) / bins).alias("high"),
    )
    return (
        edges.where("low is not null")
        .join(filled, "bin", "left")
        .select("bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("bin")
    )


def activity_boxplot(interactions: DataFrame, key: str) -> DataFrame:
    """One row: quartiles, whiskers and the number of outliers on either side."""
    counts = activity_counts(interactions, key)
    quartiles = counts.agg(F.percentile("n", [0.25, 0.5, 0.75])).scalar()
    counts = counts.withColumn("_q", quartiles)
    q1, median, q3 = (F.col("_q")[i] for i in range(3))
    reach = (q3 - q1) * WHISKER_RANGE
    lower, upper = F.col("n") < q1 - reach, F.col("n") > q3 + reach
    # whiskers never end inside the box
    whisker_low = F.least(F.min(F.when(~lower, F.col("n"))).cast("double"), F.max(q1))
    whisker_high = F.greatest(F.max(F.when(~upper, F.col("n"))).cast("double"), F.max(q3))
    return counts.agg(
        F.max(q1).alias("q1"),
        F.max(median).alias("median"),
        F.max(q3).alias("q3"),
        whisker_low.alias("whisker_low"),
        whisker_high.alias("whisker_high"),
        F.count_if(lower).alias("n_low_outliers"),
        F.count_if(upper).alias("n_high_outliers"),
    )


def activity_outliers(interactions: DataFrame, key: str) -> DataFrame:
    """(key, n) of the users or products beyond the whiskers."""
    box = activity_boxplot(interactions, key)
    low, high = box.select("whisker_low").scalar(), box.select("whisker_high").scalar()
    return activity_counts(interactions, key).where((F.col("n") < low) | (F.col("n") > high))


# --- time ----------------------------------------------------------------------------------


def monthly_activity(interactions: DataFrame, unit: str = "s") -> DataFrame:
    """(month, n, avg_rating) for months that have rows; unusable timestamps are left out."""
    if "timestamp" not in interactions.columns:
        interactions = interactions.withColumn("timestamp", F.lit(None).cast("bigint"))
    return (
        interactions.select("rating", unix_timestamp_to_month(F.col("timestamp"), unit).alias("month"))
        .where(F.col("month").isNotNull())
        .groupBy("month")
        .agg(F.count("rating").alias("n"), F.avg("rating").alias("avg_rating"))
        .orderBy("month")
    )


def temporal_trends(interactions: DataFrame, unit: str = "s") -> DataFrame:
    """One row: first and last month, number of months, peak month and its count, or skipped."""
    return trend_figures(monthly_activity(interactions, unit))


def trend_figures(months: DataFrame) -> DataFrame:
    """The same from (month, n)."""
    # of several months with the same count the first one is the peak
    peak = F.min_by("month", F.struct(-F.col("n"), F.col("month")))
    return months.agg(
        F.min("month").alias("min_date"),
        F.max("month").alias("max_date"),
        F.count(F.lit(1)).alias("n_months"),
        peak.alias("peak_month"),
        F.max("n").alias("peak_count"),
        (F.count(F.lit(1)) == 0).alias("skipped"),
    )


# --- the user x product matrix -------------------------------------------------------------


def most_active(interactions: DataFrame, key: str, size: int) -> DataFrame:
    """(key, n, position): the ``size`` ids with most ratings, ties by id, numbered from 1."""
    return largest_counts(activity_counts(interactions, key), key, size)


def largest_counts(counts: DataFrame, key: str, size: int) -> DataFrame:
    """The same from (key, n)."""
    order = [F.col("n").desc(), F.col(key).asc()]
    top = counts.orderBy(*order).limit(size)
    return top.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def top_pairs(
    interactions: DataFrame, sample_size: int = 100, counts: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """(user_id, product_id, avg_rating) of rated pairs among the most active users and products.

    Both top lists hold at most ``sample_size`` rows, so they are broadcast. ``counts`` may give
    the activity counts per key.
    """
    sample = interactions.where(F.col("rating").isNotNull())
    for key in KEY_COLUMNS:
        known = counts[key] if counts else activity_counts(interactions, key)
        top = largest_counts(known, key, sample_size).select(key)
        sample = sample.join(F.broadcast(top), key, "left_semi")
    return sample.groupBy(*KEY_COLUMNS).agg(F.avg("rating").alias("avg_rating"))


def sparsity_report(
    interactions: DataFrame, sample_size: int = 100, counts: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One row: matrix dimensions, sparsity, density, and sparsity of the most active corner.

    ``counts`` may give the activity counts per key.
    """
    counts = counts or {key: activity_counts(interactions, key) for key in KEY_COLUMNS}
    filled = top_pairs(interactions, sample_size, counts).agg(F.count(F.lit(1))).scalar()
    # Users and products are counted on the aggregates that the top lists need as well; looking at
    # n keeps both plans equal, so that they share one shuffle.
    n_users, n_products = (
        counts[key].agg(F.count_if(F.col("n") >= 0)).scalar() for key in KEY_COLUMNS
    )
    size = interactions.agg(F.count(F.lit(1)).alias("n_interactions")).select(
        n_users.alias("n_users"), n_products.alias("n_products"), "n_interactions"
    )
    filled_share = density(F.col("n_users"), F.col("n_products"), F.col("n_interactions"))
    top_users, top_products = (
        F.least(F.col(name), F.lit(sample_size)) for name in ("n_users", "n_products")
    )
    return size.select(
        F.col("n_users").cast("double"),
        F.col("n_products").cast("double"),
        F.col("n_interactions").cast("double"),
        (1 - filled_share).alias("sparsity"),
        filled_share.alias("density"),
        sparsity(top_users, top_products, filled).alias("sample_sparsity"),
    )


def interaction_heatmap(interactions: DataFrame, sample_size: int = 100) -> DataFrame:
    """(user_position, product_position, user_id, product_id, has_interaction) for the whole grid.

    Each top user lists the product positions, which are then an equi join key: the grid of at
    most ``sample_size`` squared cells needs no cross join.
    """
    users = most_active(interactions, "user_id", sample_size).select(
        "user_id",
        F.col("position").alias("user_position"),
        F.explode(F.sequence(F.lit(1), F.lit(sample_size))).alias("product_position"),
    )
    products = most_active(interactions, "product_id", sample_size).select(
        "product_id", F.col("position").alias("product_position")
    )
    pairs = top_pairs(interactions, sample_size)
    return (
        users.join(F.broadcast(products), "product_position")
        .join(pairs, list(KEY_COLUMNS), "left")
        .select(
            "user_position",
            "product_position",
            *KEY_COLUMNS,
            F.col("avg_rating").isNotNull().cast("int").alias("has_interaction"),
        )
    )


def top_rating_matrix(interactions: DataFrame, n_users: int, n_products: int) -> DataFrame:
    """Mean ratings of the most active users (rows) by the most active products (columns).

    The column names are data, so the at most ``n_products`` ids are read first.
    """
    products = most_active(interactions, "product_id", n_products)
    columns = [row["product_id"] for row in products.orderBy("position").collect()]
    users = most_active(interactions, "user_id", n_users).select("user_id", "position")
    ratings = interactions.where(F.col("product_id").isin(columns)).join(
        F.broadcast(users.select("user_id")), "user_id", "left_semi"
    )
    wide = ratings.groupBy("user_id").pivot("product_id", columns).avg("rating")
    return users.join(wide, "user_id", "left").orderBy("position").drop("position")


def filter_impact(n_raw: DataFrame, interactions: DataFrame) -> DataFrame:
    """One row: raw and processed rows, percentage kept, rows dropped. ``n_raw`` is one number."""
    counts = interactions.agg(F.count(F.lit(1)).alias("n_processed"))
    raw, kept = F.col("n_raw"), F.col("n_processed")
    return counts.select(n_raw.scalar().alias("n_raw"), "n_processed").select(
        "n_raw",
        "n_processed",
        F.when(raw > 0, kept / raw * 100).otherwise(F.lit(0.0)).alias("pct_retained"),
        F.greatest(F.lit(0), raw - kept).alias("n_dropped"),
    )


# --- categories ----------------------------------------------------------------------------


def category_counts(products: DataFrame, product_counts: DataFrame) -> DataFrame:
    """(category, n_products, n_interactions) for products that have a category."""
    return (
        products.where(F.col("category").isNotNull())
        .select("product_id", "category")
        .join(product_counts, "product_id", "left")
        .groupBy("category")
        .agg(
            F.count("product_id").alias("n_products"),
            F.sum(F.coalesce("n", F.lit(0))).alias("n_interactions"),
        )
    )


def _largest_categories(counts: DataFrame, top_n: int) -> DataFrame:
    return counts.orderBy(F.col("n_interactions").desc(), F.col("category").asc()).limit(top_n)


def top_categories(products: DataFrame, interactions: DataFrame, top_n: int = 15) -> DataFrame:
    """The ``top_n`` categories by interactions, ties by name."""
    product_counts = activity_counts(interactions, "product_id")
    return _largest_categories(category_counts(products, product_counts), top_n)


def category_stats(products: DataFrame, interactions: DataFrame, top_n: int = 15) -> DataFrame:
    """One row: number of categories, the top ones as an array, or skipped without categories."""
    return category_figures(products, activity_counts(interactions, "product_id"), top_n)


def category_figures(
    products: DataFrame, product_counts: DataFrame, top_n: int = 15
) -> DataFrame:
    """The same from (product_id, n)."""
    if "category" not in products.columns:
        products = products.withColumn("category", F.lit(None).cast("string"))
    counts = category_counts(products, product_counts)
    entry = F.struct("category", "n_products", "n_interactions")
    order = (-F.col("n_interactions")).alias("order")
    ordered = F.array_sort(F.collect_list(F.struct(order, "category", entry.alias("entry"))))
    listed = _largest_categories(counts, top_n).agg(ordered.alias("top"))
    top = listed.select(F.transform("top", lambda item: item["entry"])).scalar()
    return counts.agg(F.count(F.lit(1)).alias("n_categories")).select(
        "n_categories", top.alias("top_categories"), (F.col("n_categories") == 0).alias("skipped")
    )


# --- activity against rating ---------------------------------------------------------------


def rating_activity_correlation(users: DataFrame) -> DataFrame:
    """One row: Pearson and Spearman correlation of total_reviews and avg_rating.

    A constant column gives null. Spearman works on distinct (total_reviews, avg_rating) pairs:
    users are counted per pair before any join, so a value shared by many users is no hot key.
    """
    data = users.select("total_reviews", "avg_rating").na.drop()
    spread = F.nullif(
        F.stddev_pop("total_reviews") * F.stddev_pop("avg_rating"), F.lit(0.0)
    )
    pearson = (F.covar_pop("total_reviews", "avg_rating") / spread).alias("pearson_r")

    pairs = data.groupBy("total_reviews", "avg_rating").agg(F.count(F.lit(1)).alias("n"))
    ranked = pairs
    for column, rank in (("total_reviews", "x"), ("avg_rating", "y")):
        counts = pairs.groupBy(F.col(column).alias("value")).agg(F.sum("n").alias("n"))
        ranks = average_ranks(counts).select(F.col("value").alias(column), F.col("rank").alias(rank))
        ranked = ranked.join(ranks, column)
    # the mean of all ranks is known beforehand; centring first keeps the sums exact
    middle = pairs.agg((F.sum("n") + 1) / 2).scalar()
    ranked = ranked.withColumn("_middle", middle)
    x, y, n = F.col("x") - F.col("_middle"), F.col("y") - F.col("_middle"), F.col("n")
    rank_spread = F.nullif(F.sqrt(F.sum(n * x * x)) * F.sqrt(F.sum(n * y * y)), F.lit(0.0))
    spearman = ranked.agg((F.sum(n * x * y) / rank_spread).alias("spearman_r")).scalar()
    return data.agg(pearson).select("pearson_r", spearman.alias("spearman_r"))


def activity_rating_bins(users: DataFrame, bins: int = 40) -> DataFrame:
    """(x_bin, y_bin, n): users per cell of a grid over total_reviews and avg_rating, if any."""
    data = users.select("total_reviews", F.col("avg_rating").cast("double")).na.drop()
    columns = ("total_reviews", "avg_rating")
    span = data.agg(
        F.struct(
            *(F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns)
        )
    ).scalar()

    def bin_of(column: str) -> Column:
        low, high = F.col(f"_span.{column}.low"), F.col(f"_span.{column}.high")
        position = F.floor((F.col(column) - low) * bins / (high - low))
        return F.when(high > low, F.least(position, F.lit(bins - 1))).otherwise(F.lit(0))

    x, y = map(bin_of, columns)
    cells = data.withColumn("_span", span).groupBy(x.alias("x_bin"), y.alias("y_bin"))
    return cells.agg(F.count(F.lit(1)).alias("n"))


# --- quality report ------------------------------------------------------------------------

# The cleaning stages in order.
STAGES = ("raw", "deduplicated", "complete", "valid_rating", "cold_start")


def stage_report(counts: DataFrame) -> DataFrame:
    """(position, stage, n_rows, n_dropped) from one row with a count per stage."""
    steps = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(stage).alias("stage"),
            F.col(stage).alias("n_rows"),
            (F.col(STAGES[max(i - 1, 0)]) - F.col(stage)).alias("n_dropped"),
        )
        for i, stage in enumerate(STAGES)
    ]
    return counts.select(F.inline(F.array(*steps)))


def quality_report(counts: DataFrame, interactions: DataFrame) -> DataFrame:
    """One row: stage counts, matrix dimensions, sparsity and the rating distribution."""
    stages = stage_report(counts).agg(
        F.array_sort(F.collect_list(F.struct("position", "stage", "n_rows", "n_dropped")))
    )
    ratings = rating_frequencies(interactions)
    ratings = ratings.agg(F.array_sort(F.collect_list(F.struct("rating", "n", "share", "bar"))))
    empty = sparsity(F.col("n_users"), F.col("n_products"), F.col("n_interactions"))
    return sparsity_counts(interactions).select(
        stages.scalar().alias("stages"),
        "n_users",
        "n_products",
        "n_interactions",
        empty.alias("sparsity"),
        ratings.scalar().alias("ratings"),
    )
