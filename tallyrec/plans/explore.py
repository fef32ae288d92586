"""All descriptive analyses of the processed tables in one nested record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrec.operators import stats
from tallyrec.operators.cleaning import KEY_COLUMNS
from tallyrec.operators.distribution import value_counts
from tallyrec.session import materialize
from tallyrec.sources.readers import load_processed, raw_row_count
from tallyrec.sources.sinks import save_summary


def summarize(
    interactions: DataFrame, products: DataFrame, users: DataFrame, n_raw: DataFrame
) -> DataFrame:
    """One row with a struct per analysis.

    The interactions are aggregated once per rating, user, product and month. These tables are
    written, and all analyses but the top corner of the matrix start from them.
    """
    counts = {
        key: materialize(stats.activity_counts(interactions, key), f"counts-{key}")
        for key in KEY_COLUMNS
    }
    ratings = materialize(value_counts(interactions, "rating"), "counts-rating")
    months = materialize(stats.monthly_activity(interactions), "counts-month")
    analyses = {
        "rating_distribution": stats.rating_figures(ratings),
        "user_activity": stats.activity_figures(counts["user_id"]),
        "product_activity": stats.activity_figures(counts["product_id"]),
        "temporal_trends": stats.trend_figures(months),
        "sparsity": stats.sparsity_report(interactions, counts=counts),
        "filter_impact": stats.filter_impact(n_raw, interactions),
        "categories": stats.category_figures(products, counts["product_id"]),
        "rating_activity_correlation": stats.rating_activity_correlation(users),
    }
    return interactions.sparkSession.range(1).select(
        *(df.select(F.struct("*")).scalar().alias(name) for name, df in analyses.items())
    )


def explore_folder(
    spark: SparkSession, processed_folder: str, raw_folder: str, summary_path: str
) -> DataFrame:
    """Analyse a processed folder and write the summary as JSON."""
    tables = load_processed(spark, processed_folder)
    summary = summarize(*tables, raw_row_count(spark, raw_folder))
    save_summary(summary, summary_path)
    return summary
