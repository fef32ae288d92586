"""Review-shaped views over the given tables, in Spark and as SQL.

The SQL texts are common table expressions for the oracle queries; the functions build the same
views with the DataFrame API.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrec.operators.cleaning import (
    KEY_COLUMNS,
    drop_nulls,
    keep_valid_ratings,
    remove_duplicates,
)

VIEWS_SQL = {
    # raw reviews with nulls, repeated pairs and ratings out of range
    "reviews": """
        select case when event_id % 97 = 0 then null else cast(user_id as varchar) end as user_id,
               json_extract_string(props, '$.k') as product_id,
               case when event_id % 89 = 0 then null else value end as rating,
               epoch_us(ts) // 1000000 as "timestamp", event_id as seq
        from events""",
    # clean interactions, pairs repeated
    "lines": """
        select cast(o_custkey as varchar) as user_id, cast(l_partkey as varchar) as product_id,
               cast((cast(l_quantity as bigint) - 1) % 5 + 1 as float) as rating,
               epoch_us(l_shipdate) // 1000000 as "timestamp", l_orderkey, l_linenumber
        from lineitem join orders on l_orderkey = o_orderkey""",
    # product metadata with nulls
    "products": """
        select cast(p_partkey as varchar) as product_id,
               case when p_partkey % 7 = 0 then null else p_name end as title,
               case when p_partkey % 5 = 0 then null else p_type || ' ' || p_brand end as description,
               case when p_partkey % 11 = 0 then null else p_type end as category,
               p_retailprice as price
        from part""",
    "vectors": """
        select cast(vec_id as varchar) as product_id, cast(embedding as double[]) as embedding
        from embeddings""",
    # requests with top_k out of range
    "requests": """
        select o_orderkey as request_id, cast(o_custkey as varchar) as user_id,
               cast(o_orderkey % 104 - 1 as integer) as top_k
        from orders""",
    # the cleaning stages of the reviews
    "deduplicated": """
        select * from reviews
        qualify row_number() over (partition by user_id, product_id order by seq) = 1""",
    "complete": """
        select * from deduplicated
        where user_id is not null and product_id is not null and rating is not null""",
    "valid": "select * from complete where rating between 1 and 5",
    # one row per pair
    "interactions": """
        select user_id, product_id, rating, "timestamp" from lines
        qualify row_number() over (
            partition by user_id, product_id order by "timestamp", l_orderkey, l_linenumber) = 1""",
    "users": """
        select user_id, count(rating) as total_reviews, cast(avg(rating) as float) as avg_rating
        from interactions group by user_id""",
}

# Order of the clean interactions inside a repeated pair.
LINE_ORDER = ("timestamp", "l_orderkey", "l_linenumber")


def sql(body: str, **extra: str) -> str:
    """``body`` after the views it may read; ``extra`` adds further ones."""
    views = {**VIEWS_SQL, **extra}
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in views.items()) + body


def rounded(expression: str, digits: int = 6) -> str:
    """The SQL form of :func:`tallyrec.functions.columns.round_half_up`."""
    return f"floor(({expression}) * 1e{digits} + 0.5) / 1e{digits}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seconds(column: str):
    # the view's timestamps carry no zone; count from the epoch without one
    return F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', {column})")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reviews with nulls, repeated pairs and ratings out of range, from events."""
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 97 != 0, F.col("user_id").cast("string")).alias("user_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.when(F.col("event_id") % 89 != 0, F.col("value")).alias("rating"),
        _seconds("ts").alias("timestamp"),
        F.col("event_id").alias("seq"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean interactions from the order lines, with their order keys."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        ((F.col("l_quantity").cast("bigint") - 1) % 5 + 1).cast("float").alias("rating"),
        _seconds("l_shipdate").alias("timestamp"),
        "l_orderkey",
        "l_linenumber",
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean interactions with one row per (user, product)."""
    first = remove_duplicates(lines(spark, sf_dir), KEY_COLUMNS, LINE_ORDER)
    return first.select("user_id", "product_id", "rating", "timestamp")


def valid_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews after de-duplication, null removal and the rating check."""
    first = remove_duplicates(reviews(spark, sf_dir), KEY_COLUMNS, ["seq"])
    return keep_valid_ratings(drop_nulls(first, [*KEY_COLUMNS, "rating"]))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product metadata with nulls, from part."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("product_id"),
        F.when(key % 7 != 0, F.col("p_name")).alias("title"),
        F.when(key % 5 != 0, F.concat_ws(" ", "p_type", "p_brand")).alias("description"),
        F.when(key % 11 != 0, F.col("p_type")).alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit vectors per product, from embeddings."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("product_id"), "embedding"
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendation requests, some with top_k out of range, from orders."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        (F.col("o_orderkey") % 104 - 1).cast("int").alias("top_k"),
    )
