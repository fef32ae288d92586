"""Outputs: the processed tables, the summary as JSON, vector tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrec.sources.readers import PROCESSED_TABLES
from tallyrec.sources.versions import save_version


def save_processed(
    interactions: DataFrame, products: DataFrame, users: DataFrame, folder: str
) -> None:
    """Write the three tables as Parquet, replacing earlier ones all at once.

    They are the newest version of the folder; :func:`tallyrec.sources.readers.load_processed` reads
    it. The tables may be computed from those they replace.
    """
    names = (f"{name}.parquet" for name in PROCESSED_TABLES)
    tables = dict(zip(names, (interactions, products, users)))
    save_version(interactions.sparkSession, folder, tables)


def save_summary(summary: DataFrame, path: str) -> None:
    """Write a one-row summary as JSON."""
    summary.write.mode("overwrite").json(path)


def save_vectors(vectors: DataFrame, path: str) -> None:
    """Write (product_id, embedding array<float>); ids and vectors stay together by row."""
    vectors.select(
        F.col("product_id").cast("string"), F.col("embedding").cast("array<float>")
    ).write.mode("overwrite").parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Read a vector table written by :func:`save_vectors`."""
    return spark.read.parquet(path)
