"""Queries about sources, sinks, projections, filters and the cleaning of raw reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.registry import query, rounded, scratch
from checks.views import rounded as r
from checks.views import sql
from tallyrec.functions import columns as c
from tallyrec.operators import cleaning, stats, tables
from tallyrec.operators.cleaning import KEY_COLUMNS
from tallyrec.operators.metrics import relevant_products
from tallyrec.plans.prepare import prepare
from tallyrec.plans.serve import validate_requests, with_score_check
from tallyrec.sources import readers, sinks

REQUIRED = [*KEY_COLUMNS, "rating"]


# --- sources and sinks ---------------------------------------------------------------------


@query("select l_orderkey, l_partkey, l_linenumber, l_quantity from lineitem")
def parquet_scan(spark, sf_dir):
    source = readers.resolve_source(spark, sf_dir, "lineitem")
    return readers.read_table(spark, source).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity"
    )


@query(
    sql("""
select user_id, product_id, rating, "timestamp" as unix_seconds, seq from reviews""")
)
def load_reviews(spark, sf_dir):
    classic = views.reviews(spark, sf_dir).select(
        F.col("user_id").alias("reviewerID"),
        F.col("product_id").alias("asin"),
        F.col("rating").alias("overall"),
        F.col("timestamp").alias("unixReviewTime"),
        "seq",  # an extra column stays, whatever its name
    )
    folder = scratch(spark, "reviews")
    classic.write.parquet(f"{folder}/reviews.parquet")
    loaded = readers.load_reviews(spark, readers.resolve_source(spark, folder, "reviews"))
    return loaded.drop(readers.INPUT_ORDER).withColumnRenamed("timestamp", "unix_seconds")


def _text_reviews(spark, sf_dir, suffix, write):
    folder = scratch(spark, "text")
    path = f"{folder}/reviews.{suffix}"
    write(views.reviews(spark, sf_dir).drop("seq"), path)
    loaded = readers.load_reviews(spark, readers.resolve_source(spark, folder, "reviews"))
    return loaded.select(
        "user_id",
        "product_id",
        c.to_number(loaded, "rating").alias("rating"),
        c.to_whole_number(loaded, "timestamp").alias("unix_seconds"),
    )


TEXT_REVIEWS = sql("""
select user_id, product_id, rating, "timestamp" as unix_seconds from reviews""")


@query(TEXT_REVIEWS)
def csv_scan(spark, sf_dir):
    return _text_reviews(spark, sf_dir, "csv", lambda df, path: df.write.csv(path, header=True))


@query("select cast(doc_id as varchar) as doc_id, nullif(text, '') as body, lang from documents")
def csv_line_breaks_scan(spark, sf_dir):
    # whole texts with line breaks and quotes in quoted cells
    docs = views.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"), "lang")
    path = f"{scratch(spark, 'breaks')}/documents.csv"
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    docs.coalesce(1).write.csv(path, header=True, quoteAll=True, escape='"', **keep)
    return readers.read_table(spark, path)


@query(TEXT_REVIEWS)
def gzip_json_lines_scan(spark, sf_dir):
    return _text_reviews(
        spark, sf_dir, "jsonl.gz", lambda df, path: df.write.json(path, compression="gzip")
    )


@query(sql("select count(*) as n_raw from reviews"))
def raw_row_count(spark, sf_dir):
    folder = scratch(spark, "raw")
    views.reviews(spark, sf_dir).write.csv(f"{folder}/reviews.csv", header=True)
    return readers.raw_row_count(spark, folder)


@query("""
select cast(p_partkey as varchar) as product_id, p_name as title,
       case when p_partkey % 13 = 0 then null
            else p_type || ' ' || p_brand end as description,
       case when p_partkey % 11 = 0 then null else p_type end as category,
       p_retailprice as price
from part""")
def load_products(spark, sf_dir):
    key = F.col("p_partkey")
    brand_and_type = F.array(F.col("p_type"), F.lit(""), F.col("p_brand"), F.lit(None))
    raw = views.table(spark, sf_dir, "part").select(
        key.cast("string").alias("parent_asin"),
        F.col("p_name").alias("title"),
        F.when(key % 13 == 0, F.array(F.lit(""))).otherwise(brand_and_type).alias("description"),
        F.when(key % 11 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.col("p_brand"), F.col("p_type")))
        .alias("categories"),
        F.col("p_retailprice").alias("price"),
    )
    folder = scratch(spark, "products")
    raw.write.parquet(f"{folder}/products.parquet")
    return readers.load_products(spark, readers.resolve_source(spark, folder, "products"))


@query(
    sql("""
select 'interactions' as name, count(*) as n, cast(sum(cast(product_id as bigint)) as bigint) as ids
from interactions union all
select 'products', count(*), cast(sum(cast(product_id as bigint)) as bigint) from products
where product_id in (select product_id from interactions) union all
select 'users', count(*), cast(sum(cast(user_id as bigint)) as bigint) from users""")
)
def processed_tables(spark, sf_dir):
    folder = scratch(spark, "processed")
    interactions = tables.build_interactions(views.interactions(spark, sf_dir))
    sinks.save_processed(
        interactions,
        tables.build_products(interactions, views.products(spark, sf_dir)),
        tables.build_users(interactions),
        folder,
    )
    loaded = readers.load_processed(spark, folder)

    def line(name, df, key):
        return df.agg(
            F.lit(name).alias("name"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col(key).cast("bigint")).alias("ids"),
        )

    return (
        line("interactions", loaded.interactions, "product_id")
        .union(line("products", loaded.products, "product_id"))
        .union(line("users", loaded.users, "user_id"))
    )


# --- projections ---------------------------------------------------------------------------


@query(
    sql("""
select user_id, product_id, cast(rating as double) as rating, "timestamp" as unix_seconds
from interactions""")
)
def interactions_table(spark, sf_dir):
    built = tables.build_interactions(views.interactions(spark, sf_dir))
    return built.select(
        "user_id",
        "product_id",
        F.col("rating").cast("double"),
        F.col("timestamp").alias("unix_seconds"),
    )


@query("""
select event_id, case when event_id % 5 in (0, 2) then null else value end as number,
       case when event_id % 2 = 0 then null else event_id end as whole
from events""")
def numeric_coercion(spark, sf_dir):
    text = F.col("value").cast("string")
    which = F.col("event_id") % 5
    written = views.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(which == 0, F.concat(text, F.lit("d")))
        .when(which == 1, F.concat(F.lit(" +"), text, F.lit(" ")))
        .when(which == 2, F.concat(F.lit("x"), text))
        .when(which == 3, F.concat(text, F.lit("e0")))
        .otherwise(text)
        .alias("number"),
        F.concat("event_id", F.when(F.col("event_id") % 2 == 0, ".5").otherwise(".0")).alias("whole"),
    )
    return written.select(
        "event_id",
        c.to_number(written, "number").alias("number"),
        c.to_whole_number(written, "whole").alias("whole"),
    )


@query("""
select p_partkey, case when p_partkey % 3 = 0 then null else p_type end as nested,
       case when p_partkey % 4 = 0 then null else p_type end as flat, p_type as plain
from part""")
def flatten_category(spark, sf_dir):
    key = F.col("p_partkey")
    levels = F.array("p_brand", "p_type")
    none = F.array().cast("array<string>")
    parts = views.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(key % 6 == 0, F.array(none))
        .when(key % 6 == 3, F.array().cast("array<array<string>>"))
        .otherwise(F.array(levels, F.array("p_name")))
        .alias("nested"),
        F.when(key % 4 == 0, none).otherwise(levels).alias("flat"),
        F.col("p_type").alias("plain"),
    )
    return parts.select(
        "p_partkey",
        *(c.flatten_category(parts, name).alias(name) for name in ("nested", "flat", "plain")),
    )


@query("""
select p_partkey,
       case when p_partkey % 3 = 0 then null
            when p_partkey % 3 = 1 then p_name else p_name || ' ' || p_brand end as description
from part""")
def flatten_description(spark, sf_dir):
    rest = F.col("p_partkey") % 3
    parts = views.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.array(
            F.when(rest == 0, "").otherwise(F.col("p_name")),
            F.lit(None),
            F.lit(""),
            F.when(rest == 2, F.col("p_brand")),
        ).alias("description"),
    )
    return parts.select("p_partkey", c.flatten_description(parts).alias("description"))


@query(
    sql("""
select distinct product_id, cast(null as varchar) as title, cast(null as varchar) as description,
       cast(null as varchar) as category, cast(null as double) as price
from interactions""")
)
def products_without_metadata(spark, sf_dir):
    return tables.build_products(views.interactions(spark, sf_dir))


@query(
    sql("""
select product_id, title, description, category, price from products
where product_id in (select product_id from valid)""")
)
def products_with_metadata(spark, sf_dir):
    return tables.build_products(
        views.valid_reviews(spark, sf_dir), views.products(spark, sf_dir)
    )


@query("""
with times as (
    select event_id,
           (epoch_us(ts) // 1000000) * case when event_id % 3 = 0 then 1000 else 1 end as seconds
    from events)
select event_id,
       case when seconds <= 9223372036 then strftime(to_timestamp(seconds) at time zone 'UTC',
            '%Y-%m-%d %H:%M:%S') end as time,
       case when seconds <= 9223372036 then strftime(to_timestamp(seconds) at time zone 'UTC',
            '%Y-%m') end as month
from times""")
def review_times(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    # every third timestamp in milliseconds, as newer review dumps have it
    seconds = seconds * F.when(F.col("event_id") % 3 == 0, 1000).otherwise(1)
    return events.select(
        "event_id",
        F.date_format(c.unix_timestamp_to_time(seconds), "yyyy-MM-dd HH:mm:ss").alias("time"),
        c.unix_timestamp_to_month(seconds).alias("month"),
    )


@query(f"""
select l_orderkey, l_linenumber, l_partkey, {r("l_extendedprice / 7.0", 4)} as four_digits,
       {r("l_discount / 7.0", 6)} as six_digits
from lineitem""")
def score_rounding(spark, sf_dir):
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        c.round_half_up(F.col("l_extendedprice") / 7.0, 4).alias("four_digits"),
        c.round_half_up(F.col("l_discount") / 7.0, 6).alias("six_digits"),
    )


# --- filters and cleaning ------------------------------------------------------------------


@query(sql("select user_id, product_id, rating, seq from deduplicated"))
def remove_duplicates(spark, sf_dir):
    first = cleaning.remove_duplicates(views.reviews(spark, sf_dir), KEY_COLUMNS, ["seq"])
    return first.select(*REQUIRED, "seq")


@query(
    sql("""
select user_id, product_id, rating, seq from reviews
where user_id is not null and product_id is not null and rating is not null""")
)
def drop_nulls(spark, sf_dir):
    return cleaning.drop_nulls(views.reviews(spark, sf_dir), REQUIRED).select(*REQUIRED, "seq")


@query(sql("select user_id, product_id, rating, seq from reviews where rating between 1 and 5"))
def valid_ratings(spark, sf_dir):
    return cleaning.keep_valid_ratings(views.reviews(spark, sf_dir)).select(*REQUIRED, "seq")


@query(
    sql("""
select user_id, product_id, l_orderkey, l_linenumber from lines
where product_id in (select product_id from valid)""")
)
def keep_members(spark, sf_dir):
    rows = views.lines(spark, sf_dir).select(*KEY_COLUMNS, "l_orderkey", "l_linenumber")
    return cleaning.keep_members(rows, views.valid_reviews(spark, sf_dir), "product_id")


# more passes than any of the cases needs; passes beyond the fixpoint change nothing
PASSES = 14


def core_views(source: str, min_user: int, min_product: int) -> str:
    """Views u1, p1, u2, p2, ...: the rows left after each half of each cold-start pass."""
    parts = [f"p0 as materialized (select * from {source})"]
    for i in range(1, PASSES + 1):
        parts.append(f"""u{i} as materialized (select * from p{i - 1} where user_id in (
            select user_id from p{i - 1} group by user_id having count(*) >= {min_user}))""")
        parts.append(f"""p{i} as materialized (select * from u{i} where product_id in (
            select product_id from u{i} group by product_id having count(*) >= {min_product}))""")
    return ", " + ",\n".join(parts)


def core_sql(source: str, min_user: int, min_product: int, body: str) -> str:
    return sql(core_views(source, min_user, min_product) + body)


def core_rows(rating: str = "rating") -> str:
    return f"""
select user_id, product_id, cast({rating} as double) as rating, "timestamp" as unix_seconds
from p{PASSES}"""


def _core(df, min_user, min_product):
    kept = cleaning.filter_cold_start(df, min_user, min_product).interactions
    return kept.select(
        *KEY_COLUMNS, F.col("rating").cast("double"), F.col("timestamp").alias("unix_seconds")
    )


@query(core_sql("valid", 3, 4, core_rows()))
def cold_start_reviews(spark, sf_dir):
    return _core(views.valid_reviews(spark, sf_dir), 3, 4)


@query(core_sql("valid", 5, 10, core_rows()))
def cold_start_reviews_default(spark, sf_dir):
    return _core(views.valid_reviews(spark, sf_dir), 5, 10)


@query(core_sql("interactions", 5, 10, core_rows()))
def cold_start_interactions_default(spark, sf_dir):
    return _core(views.interactions(spark, sf_dir), 5, 10)


@query(
    core_sql("interactions", 20, 25, core_rows())
)
def cold_start_interactions(spark, sf_dir):
    return _core(views.interactions(spark, sf_dir), 20, 25)


DROPPED_ROWS = "\nselect cast({users} as bigint) as user_rows, cast({products} as bigint) as product_rows".format(
    users=" + ".join(
        f"(select count(*) from p{i - 1}) - (select count(*) from u{i})" for i in range(1, PASSES + 1)
    ),
    products=" + ".join(
        f"(select count(*) from u{i}) - (select count(*) from p{i})" for i in range(1, PASSES + 1)
    ),
)


@query(core_sql("interactions", 20, 25, DROPPED_ROWS))
def cold_start_dropped(spark, sf_dir):
    result = cleaning.filter_cold_start(views.interactions(spark, sf_dir), 20, 25)
    return spark.createDataFrame(
        [(result.user_rows_dropped, result.product_rows_dropped)],
        "user_rows bigint, product_rows bigint",
    )


@query(sql("select distinct user_id, product_id from interactions where rating >= 4"))
def relevant_pairs(spark, sf_dir):
    return relevant_products(views.interactions(spark, sf_dir))


@query(
    sql("""
select request_id, user_id, top_k,
       case when top_k < 1 then 'top_k is below 1'
            when top_k > 100 then 'top_k is above 100' end as reason,
       case when top_k between 1 and 100 then 'ok' else 'invalid' end as status
from requests""")
)
def request_validation(spark, sf_dir):
    return validate_requests(views.requests(spark, sf_dir))


@query("""
select l_orderkey, l_linenumber, l_partkey, l_quantity / 40 - 0.1 as score,
       l_quantity / 40 - 0.1 between 0 and 1 as score_in_range
from lineitem""")
def score_check(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    return with_score_check(
        lines.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            (F.col("l_quantity") / 40 - F.lit(0.1)).alias("score"),
        )
    )


# --- tables and the whole preparation ------------------------------------------------------


@query(sql(f"select user_id, total_reviews, {r('avg_rating')} as avg_rating from users"))
def users_table(spark, sf_dir):
    built = tables.build_users(tables.build_interactions(views.interactions(spark, sf_dir)))
    return built.select("user_id", "total_reviews", rounded("avg_rating"))


@query(
    sql("""
select count(distinct user_id) as n_users, count(distinct product_id) as n_products,
       count(*) as n_interactions
from reviews""")
)
def distinct_counts(spark, sf_dir):
    return tables.sparsity_counts(views.reviews(spark, sf_dir))


def _prepare_lines(spark, sf_dir):
    return prepare(
        views.lines(spark, sf_dir), views.products(spark, sf_dir), 20, 25, views.LINE_ORDER
    )


@query(core_sql("valid", 3, 4, core_rows("cast(rating as float)")))
def prepare_interactions(spark, sf_dir):
    prepared = prepare(views.reviews(spark, sf_dir), views.products(spark, sf_dir), 3, 4, ["seq"])
    return prepared.interactions.select(
        *KEY_COLUMNS, F.col("rating").cast("double"), F.col("timestamp").alias("unix_seconds")
    )


@query(
    core_sql(
        "interactions",
        20,
        25,
        f"\nselect * from products where product_id in (select product_id from p{PASSES})",
    )
)
def prepare_products(spark, sf_dir):
    return _prepare_lines(spark, sf_dir).products


@query(
    core_sql(
        "interactions",
        20,
        25,
        f"""
select user_id, count(*) as total_reviews, {r("cast(avg(rating) as float)")} as avg_rating
from p{PASSES} group by user_id""",
    )
)
def prepare_users(spark, sf_dir):
    return _prepare_lines(spark, sf_dir).users.select(
        "user_id", "total_reviews", rounded("avg_rating")
    )


@query(
    core_sql(
        "valid",
        3,
        4,
        f""",
stages as (
    select 0 as position, 'raw' as stage, (select count(*) from reviews) as n_rows union all
    select 1, 'deduplicated', (select count(*) from deduplicated) union all
    select 2, 'complete', (select count(*) from complete) union all
    select 3, 'valid_rating', (select count(*) from valid) union all
    select 4, 'cold_start', (select count(*) from p{PASSES}))
select position, stage, n_rows,
       coalesce(lag(n_rows) over (order by position) - n_rows, 0) as n_dropped
from stages""",
    )
)
def stage_report(spark, sf_dir):
    prepared = prepare(views.reviews(spark, sf_dir), views.products(spark, sf_dir), 3, 4, ["seq"])
    return stats.stage_report(prepared.stage_counts)


@query(
    core_sql(
        "interactions",
        20,
        25,
        f""",
size as (
    select count(distinct user_id) as n_users, count(distinct product_id) as n_products,
           count(*) as n_interactions
    from p{PASSES}),
ratings as (select rating, count(*) as n from p{PASSES} group by rating)
select n_users, n_products, n_interactions,
       {r("1 - n_interactions / (cast(n_users as double) * n_products)")} as sparsity,
       cast(rating as double) as rating, n, {r("n / n_interactions")} as share,
       repeat('#', cast(floor(n / n_interactions * 40) as int)) as bar
from size, ratings""",
    )
)
def quality_report(spark, sf_dir):
    report = _prepare_lines(spark, sf_dir).report
    flat = report.select(
        "n_users", "n_products", "n_interactions", rounded("sparsity"), F.inline("ratings")
    )
    return flat.withColumns({"rating": F.col("rating").cast("double"), "share": rounded("share")})
