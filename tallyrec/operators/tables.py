"""The three clean tables: interactions, products, users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.functions.columns import as_seconds, to_whole_number
from tallyrec.operators.cleaning import keep_members

# The columns of the product table and their types.
PRODUCT_COLUMNS = {
    "product_id": "string",
    "title": "string",
    "description": "string",
    "category": "string",
    "price": "double",
}


def build_interactions(reviews: DataFrame, unit: str = "s") -> DataFrame:
    """(user_id string, product_id string, rating float, timestamp bigint in unix seconds).

    ``unit`` is that of the timestamps of ``reviews``, "s" or "ms".
    """
    seconds = (
        as_seconds(to_whole_number(reviews, "timestamp"), unit)
        if "timestamp" in reviews.columns
        else F.lit(None).cast("bigint")
    )
    return reviews.select(
        F.col("user_id").cast("string"),
        F.col("product_id").cast("string"),
        F.col("rating").cast("float"),
        seconds.alias("timestamp"),
    )


def fill_product_columns(products: DataFrame) -> DataFrame:
    """The fixed product columns; missing ones are null, unreadable prices too."""
    return products.select(
        *(
            (F.col(name).try_cast(kind) if name in products.columns else F.lit(None).cast(kind))
            .alias(name)
            for name, kind in PRODUCT_COLUMNS.items()
        )
    )


def build_products(interactions: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Metadata rows of active products; without metadata, the distinct active ids.

    Active products without metadata do not appear, and repeated metadata rows stay.
    """
    active = interactions.select(F.col("product_id").cast("string")).distinct()
    if metadata is None:
        return fill_product_columns(active)
    return keep_members(fill_product_columns(metadata), active, "product_id")


def build_users(interactions: DataFrame) -> DataFrame:
    """(user_id, total_reviews, avg_rating): number and mean of the non-null ratings per user."""
    return (
        interactions.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count("rating").alias("total_reviews"),
            F.avg("rating").cast("float").alias("avg_rating"),
        )
    )


def sparsity_counts(interactions: DataFrame) -> DataFrame:
    """One row: distinct users, distinct products, interaction rows."""
    return interactions.agg(
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("product_id").alias("n_products"),
        F.count(F.lit(1)).alias("n_interactions"),
    )
