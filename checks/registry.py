"""Collects the queries and, where SQL can express them, the SQL they must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrec.functions.columns import round_half_up
from tallyrec.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; without SQL only rows and schema can be compared."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def once_per_session(build: Callable) -> Callable:
    """Remember what ``build(spark, sf_dir)`` returned for this application and data folder."""
    known: dict[tuple[str, str], object] = {}

    def get(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in known:
            known[key] = build(spark, sf_dir)
        return known[key]

    return get


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, for queries about writing and reading back."""
    return f"{shared_folder(spark)}/check-{label}-{uuid.uuid4().hex}"


def rounded(name: str, digits: int = 6, alias: str | None = None):
    """A figure rounded the way the SQL rounds it."""
    return round_half_up(F.col(name).cast("double"), digits).alias(alias or name)
