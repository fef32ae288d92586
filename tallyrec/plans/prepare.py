"""From raw reviews to the three clean tables and the quality report."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrec.operators.cleaning import (
    KEY_COLUMNS,
    ColdStart,
    drop_nulls,
    filter_cold_start,
    keep_valid_ratings,
    remove_duplicates,
)
from tallyrec.operators.stats import STAGES, quality_report
from tallyrec.operators.tables import build_interactions, build_products, build_users
from tallyrec.session import materialize
from tallyrec.sources.readers import (
    INPUT_ORDER,
    REQUIRED_REVIEW_COLUMNS,
    SUFFIXES,
    load_products,
    load_reviews,
    resolve_source,
)
from tallyrec.sources.sinks import save_processed

# Default thresholds of the cold-start filter.
MIN_USER_REVIEWS = 5
MIN_PRODUCT_REVIEWS = 10


class Prepared(NamedTuple):
    """The clean tables, the rows left after each stage, and the quality report."""

    interactions: DataFrame
    products: DataFrame
    users: DataFrame
    stage_counts: DataFrame
    report: DataFrame
    cold_start: ColdStart


def prepare(
    reviews: DataFrame,
    products: DataFrame | None = None,
    min_user_reviews: int = MIN_USER_REVIEWS,
    min_product_reviews: int = MIN_PRODUCT_REVIEWS,
    order_by: tuple[str | Column, ...] = (INPUT_ORDER,),
    unit: str = "s",
) -> Prepared:
    """Clean raw reviews and build the tables.

    The order of the stages matters: of a repeated (user, product) pair only the first row
    counts, even if a later check then drops that row. ``unit`` is that of the timestamps.
    """
    columns = [*REQUIRED_REVIEW_COLUMNS, *({"timestamp"} & set(reviews.columns))]
    # The raw input is read once: its rows are counted on the way to the written table, which the
    # stage counts and the cold-start filter read.
    seen, n_raw = reviews, 0
    if not reviews.isEmpty():
        rows = Observation()
        seen = reviews.observe(rows, F.count(F.lit(1)).alias("n"))
    first = remove_duplicates(seen, KEY_COLUMNS, order_by).select(*columns)
    first = materialize(first, "deduplicated")
    if seen is not reviews:
        n_raw = rows.get["n"]
    valid = materialize(keep_valid_ratings(drop_nulls(first, REQUIRED_REVIEW_COLUMNS)), "valid")
    kept = filter_cold_start(valid, min_user_reviews, min_product_reviews)
    interactions = materialize(build_interactions(kept.interactions, unit), "interactions")

    present = F.lit(True)
    for name in REQUIRED_REVIEW_COLUMNS:
        missing = F.col(name).isNull()
        if isinstance(first.schema[name].dataType, (T.DoubleType, T.FloatType)):
            missing = missing | F.isnan(name)
        present = present & ~missing
    stages = first.agg(
        F.lit(n_raw).cast("bigint").alias(STAGES[0]),
        F.count(F.lit(1)).alias(STAGES[1]),
        F.count_if(present).alias(STAGES[2]),
    )
    counts = stages.select(
        "*",
        valid.agg(F.count(F.lit(1))).scalar().alias(STAGES[3]),
        interactions.agg(F.count(F.lit(1))).scalar().alias(STAGES[4]),
    )
    return Prepared(
        interactions,
        build_products(interactions, products),
        build_users(interactions),
        counts,
        quality_report(counts, interactions),
        kept,
    )


def prepare_folder(
    spark: SparkSession,
    raw_folder: str,
    processed_folder: str,
    min_user_reviews: int = MIN_USER_REVIEWS,
    min_product_reviews: int = MIN_PRODUCT_REVIEWS,
    unit: str = "s",
) -> Prepared:
    """Find and read the raw inputs of a folder, clean them, and write the three tables."""
    path = resolve_source(spark, raw_folder, "reviews")
    if path is None:
        names = ", ".join(f"reviews.{suffix}" for suffix in SUFFIXES)
        raise FileNotFoundError(f"no reviews in {raw_folder}; supported names: {names}")
    prepared = prepare(
        load_reviews(spark, path),
        load_products(spark, resolve_source(spark, raw_folder, "products")),
        min_user_reviews,
        min_product_reviews,
        unit=unit,
    )
    save_processed(prepared.interactions, prepared.products, prepared.users, processed_folder)
    return prepared
