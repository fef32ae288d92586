"""Queries about the descriptive statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.registry import once_per_session, query, rounded, scratch
from checks.views import rounded as r
from checks.views import sql
from tallyrec.operators import distribution, stats, tables
from tallyrec.plans.explore import summarize
from tallyrec.session import materialize
from tallyrec.sources import sinks

ACTIVITY = {
    "mean": "avg(n)",
    "std": "stddev_samp(n)",
    "min": "min(n)",
    "max": "max(n)",
    "median": "quantile_cont(n, 0.5)",
    "p25": "quantile_cont(n, 0.25)",
    "p75": "quantile_cont(n, 0.75)",
    "p95": "quantile_cont(n, 0.95)",
    "p99": "quantile_cont(n, 0.99)",
}
RATINGS = {
    "mean": "avg(rating)",
    "median": "quantile_cont(rating, 0.5)",
    "std": "stddev_samp(rating)",
    "min": "min(rating)",
    "max": "max(rating)",
    **{f"pct_{i}": f"count(*) filter (floor(rating) = {i}) / count(*)" for i in range(1, 6)},
}


def figures(parts: dict[str, str], prefix: str = "") -> str:
    return ", ".join(f'{r(expression)} as "{prefix}{name}"' for name, expression in parts.items())


def counts_view(key: str, name: str = "counts") -> str:
    return f", {name} as (select {key}, count(rating) as n from interactions group by {key})"


@once_per_session
def _users(spark, sf_dir):
    return materialize(tables.build_users(_built(spark, sf_dir)), "users")


def _all_rounded(df, names):
    return df.select(*(rounded(name) for name in names))


@once_per_session
def _built(spark, sf_dir):
    """The interactions as a written table: the analyses start from processed tables."""
    return materialize(tables.build_interactions(views.interactions(spark, sf_dir)), "interactions")


@query(sql(f"select {figures(RATINGS)} from interactions where rating is not null"))
def rating_distribution(spark, sf_dir):
    return _all_rounded(stats.rating_distribution(_built(spark, sf_dir)), RATINGS)


@query(sql(f"select {figures(RATINGS)} from valid"))
def rating_distribution_fractional(spark, sf_dir):
    return _all_rounded(stats.rating_distribution(views.valid_reviews(spark, sf_dir)), RATINGS)


@query(
    sql(f"""
select cast(rating as double) as value, {r("count(*) / sum(count(*)) over ()")} as share
from (select rating * 3 - 4 as rating from reviews) where rating is not null group by rating""")
)
def rating_shares(spark, sf_dir):
    # far outside the stars, too
    wide = views.reviews(spark, sf_dir).withColumn("rating", F.col("rating") * 3 - 4)
    shares = stats.rating_distribution(wide).select(F.inline("shares"))
    return shares.select("value", rounded("share"))


FREQUENCIES = f"""
select rating, n, {r("n / sum(n) over ()")} as share,
       repeat('#', cast(floor(n / sum(n) over () * 40) as int)) as bar
from (select cast(rating as double) as rating, count(*) as n from {{}}
      where rating is not null group by rating)"""


@query(sql(FREQUENCIES.format("interactions")))
def rating_frequencies(spark, sf_dir):
    found = stats.rating_frequencies(_built(spark, sf_dir))
    return found.select(F.col("rating").cast("double"), "n", rounded("share"), "bar")


@query(
    sql(f"""
select {figures({"q10": "quantile_cont(value, 0.1)", "q50": "quantile_cont(value, 0.5)",
                 "q90": "quantile_cont(value, 0.9)", "q99": "quantile_cont(value, 0.99)"})}
from events""")
)
def exact_quantiles(spark, sf_dir):
    shares = {"q10": 0.1, "q50": 0.5, "q90": 0.9, "q99": 0.99}
    events = views.table(spark, sf_dir, "events")
    return _all_rounded(distribution.exact_quantiles(events, "value", shares), shares)


@query(
    sql("""
select distinct value, rank() over (order by value) + (count(*) over (partition by value) - 1) / 2.0
       as "rank"
from events where value is not null""")
)
def average_ranks(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    return distribution.average_ranks(distribution.value_counts(events, "value"))


@query(sql("select user_id, count(rating) as n from reviews where user_id is not null group by 1"))
def activity_counts(spark, sf_dir):
    return stats.activity_counts(views.reviews(spark, sf_dir), "user_id")


@query(sql(counts_view("user_id") + f" select {figures(ACTIVITY)} from counts"))
def user_activity(spark, sf_dir):
    return _all_rounded(stats.user_activity(_built(spark, sf_dir)), ACTIVITY)


@query(sql(counts_view("product_id") + f" select {figures(ACTIVITY)} from counts"))
def product_activity(spark, sf_dir):
    return _all_rounded(stats.product_activity(_built(spark, sf_dir)), ACTIVITY)


HISTOGRAM = f"""
, span as (select min(n) as low, max(n) as high from counts),
bins as (
    select cast(least(floor((n - low) * 50.0 / (high - low)), 49) as bigint) as bin, count(*) as n
    from counts, span group by 1)
select b.bin, {r("low + (high - low) * b.bin / 50.0")} as low,
       {r("low + (high - low) * (b.bin + 1) / 50.0")} as high, coalesce(n, 0) as n
from (select unnest(range(50)) as bin) b left join bins on b.bin = bins.bin, span"""


@query(sql(counts_view("user_id") + HISTOGRAM))
def user_activity_histogram(spark, sf_dir):
    bins = stats.activity_histogram(_built(spark, sf_dir), "user_id")
    return bins.select("bin", rounded("low"), rounded("high"), "n")


@query(sql(counts_view("product_id") + HISTOGRAM))
def product_activity_histogram(spark, sf_dir):
    bins = stats.activity_histogram(_built(spark, sf_dir), "product_id")
    return bins.select("bin", rounded("low"), rounded("high"), "n")


BOX = """
, box as (
    select quantile_cont(n, 0.25) as q1, quantile_cont(n, 0.5) as median,
           quantile_cont(n, 0.75) as q3
    from counts),
fences as (select *, q1 - 1.5 * (q3 - q1) as low_fence, q3 + 1.5 * (q3 - q1) as high_fence from box)
"""
BOX_ROW = """
select any_value(q1) as q1, any_value(median) as median, any_value(q3) as q3,
       least(cast(min(n) filter (n >= low_fence) as double), any_value(q1)) as whisker_low,
       greatest(cast(max(n) filter (n <= high_fence) as double), any_value(q3)) as whisker_high,
       count(*) filter (n < low_fence) as n_low_outliers,
       count(*) filter (n > high_fence) as n_high_outliers
from counts, fences"""


@query(sql(counts_view("user_id") + BOX + BOX_ROW))
def user_activity_boxplot(spark, sf_dir):
    return stats.activity_boxplot(_built(spark, sf_dir), "user_id")


@query(sql(counts_view("product_id") + BOX + BOX_ROW))
def product_activity_boxplot(spark, sf_dir):
    return stats.activity_boxplot(_built(spark, sf_dir), "product_id")


@query(
    sql(
        counts_view("user_id")
        + BOX
        + "select user_id, n from counts, fences where n < low_fence or n > high_fence"
    )
)
def user_activity_outliers(spark, sf_dir):
    return stats.activity_outliers(_built(spark, sf_dir), "user_id")


MONTHS = """, months as (
    select strftime(to_timestamp("timestamp") at time zone 'UTC', '%Y-%m') as month,
           count(rating) as n, avg(rating) as avg_rating
    from interactions where "timestamp" is not null group by 1)"""
TRENDS = """
select min(month) as min_date, max(month) as max_date, count(*) as n_months,
       (select month from months order by n desc, month limit 1) as peak_month,
       max(n) as peak_count, count(*) = 0 as skipped
from months"""


@query(sql(MONTHS + f" select month, n, {r('avg_rating')} as avg_rating from months"))
def monthly_activity(spark, sf_dir):
    return stats.monthly_activity(_built(spark, sf_dir)).select("month", "n", rounded("avg_rating"))


@query(sql(MONTHS + TRENDS))
def temporal_trends(spark, sf_dir):
    return stats.temporal_trends(_built(spark, sf_dir))


@query(sql(MONTHS + TRENDS))
def temporal_trends_ms(spark, sf_dir):
    fine = views.interactions(spark, sf_dir).withColumn("timestamp", F.col("timestamp") * 1000 + 999)
    return stats.temporal_trends(fine, "ms")


@query(sql(MONTHS.replace('where "timestamp" is not null', "where false") + TRENDS))
def temporal_trends_skipped(spark, sf_dir):
    return stats.temporal_trends(views.interactions(spark, sf_dir).drop("timestamp"))


SIZE = """
, top_users as (
    select user_id,
           cast(row_number() over (order by count(rating) desc, user_id) as int) as user_position
    from interactions group by user_id qualify user_position <= 100),
top_products as (
    select product_id,
           cast(row_number() over (order by count(rating) desc, product_id) as int) as product_position
    from interactions group by product_id qualify product_position <= 100),
sampled as (
    select user_id, product_id, avg(rating) as avg_rating from interactions
    where user_id in (select user_id from top_users) and rating is not null
      and product_id in (select product_id from top_products)
    group by 1, 2),
size as (
    select cast(count(distinct user_id) as double) as n_users,
           cast(count(distinct product_id) as double) as n_products,
           cast(count(*) as double) as n_interactions
    from interactions)"""
SPARSITY = {
    "n_users": "n_users",
    "n_products": "n_products",
    "n_interactions": "n_interactions",
    "sparsity": "1 - n_interactions / (n_users * n_products)",
    "density": "n_interactions / (n_users * n_products)",
    "sample_sparsity": """1 - (select count(*) from sampled) / (
        (select count(*) from top_users) * (select count(*) from top_products))""",
}


@query(sql(SIZE + f" select {figures(SPARSITY)} from size"))
def sparsity_report(spark, sf_dir):
    return _all_rounded(stats.sparsity_report(_built(spark, sf_dir)), SPARSITY)


@query(
    sql(
        SIZE
        + """
select user_position, product_position, u.user_id, p.product_id,
       cast(avg_rating is not null as int) as has_interaction
from top_users u cross join top_products p
left join sampled s on s.user_id = u.user_id and s.product_id = p.product_id"""
    )
)
def interaction_heatmap(spark, sf_dir):
    return stats.interaction_heatmap(_built(spark, sf_dir))


@query(sql(SIZE + f" select user_id, product_id, {r('avg_rating')} as avg_rating from sampled"))
def top_pairs(spark, sf_dir):
    return stats.top_pairs(_built(spark, sf_dir)).select(
        "user_id", "product_id", rounded("avg_rating")
    )


@query(
    sql("""
select user_id, count(rating) as n,
       cast(row_number() over (order by count(rating) desc, user_id) as int) as position
from interactions group by user_id qualify position <= 100""")
)
def most_active_users(spark, sf_dir):
    return stats.most_active(_built(spark, sf_dir), "user_id", 100)


@query(
    sql(
        SIZE
        + f"""
select user_id, product_id, {r('avg(rating)')} as avg_rating
from interactions join top_users using (user_id) join top_products using (product_id)
where rating is not null group by user_id, product_id"""
    )
)
def top_rating_matrix(spark, sf_dir):
    wide = stats.top_rating_matrix(_built(spark, sf_dir), 100, 100)
    products = [F.col(f"`{name}`") for name in wide.columns[1:]]
    long = wide.unpivot("user_id", products, "product_id", "avg_rating")
    return long.where("avg_rating is not null").select("user_id", "product_id", rounded("avg_rating"))


IMPACT = {
    "n_raw": "(select count(*) from lines)",
    "n_processed": "count(*)",
    "pct_retained": "count(*) / (select count(*) from lines) * 100",
    "n_dropped": "greatest(0, (select count(*) from lines) - count(*))",
}


@query(sql(f"select {figures(IMPACT)} from interactions"))
def filter_impact(spark, sf_dir):
    n_raw = views.lines(spark, sf_dir).agg(F.count(F.lit(1)))
    return _all_rounded(stats.filter_impact(n_raw, _built(spark, sf_dir)), IMPACT)


CATEGORIES = """
, category_counts as (
    select category, count(p.product_id) as n_products,
           cast(sum(coalesce(n, 0)) as bigint) as n_interactions
    from products p
    left join (select product_id, count(rating) as n from interactions group by 1) i
      on i.product_id = p.product_id
    where category is not null group by category)"""


@query(sql(CATEGORIES + "select * from category_counts order by n_interactions desc, category limit 15"))
def top_categories(spark, sf_dir):
    return stats.top_categories(views.products(spark, sf_dir), _built(spark, sf_dir))


@query(
    sql(
        CATEGORIES
        + """
select (select count(*) from category_counts) as n_categories, *
from category_counts order by n_interactions desc, category limit 3"""
    )
)
def category_stats(spark, sf_dir):
    found = stats.category_stats(views.products(spark, sf_dir), _built(spark, sf_dir), 3)
    return found.select("n_categories", F.inline("top_categories"))


RANKS = """
, ranks as (
    select cast(rank() over (order by total_reviews) as double)
             + (count(*) over (partition by total_reviews) - 1) / 2.0 as x,
           cast(rank() over (order by avg_rating) as double)
             + (count(*) over (partition by avg_rating) - 1) / 2.0 as y
    from users where avg_rating is not null)"""
CORRELATION = {
    "pearson_r": """(select covar_pop(total_reviews, avg_rating)
        / nullif(stddev_pop(total_reviews) * stddev_pop(avg_rating), 0) from users)""",
    "spearman_r": "(select covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) from ranks)",
}


@query(sql(RANKS + f" select {figures(CORRELATION)}"))
def rating_activity_correlation(spark, sf_dir):
    found = stats.rating_activity_correlation(_users(spark, sf_dir))
    return _all_rounded(found, CORRELATION)


@query(
    sql("""
, span as (
    select min(total_reviews) as x_low, max(total_reviews) as x_high,
           cast(min(avg_rating) as double) as y_low, cast(max(avg_rating) as double) as y_high
    from users)
select cast(least(floor((total_reviews - x_low) * 40.0 / (x_high - x_low)), 39) as bigint) as x_bin,
       cast(least(floor((cast(avg_rating as double) - y_low) * 40 / (y_high - y_low)), 39) as bigint)
         as y_bin, count(*) as n
from users, span group by 1, 2""")
)
def activity_rating_bins(spark, sf_dir):
    return stats.activity_rating_bins(_users(spark, sf_dir))


SUMMARY_SQL = (
    SIZE
    + CATEGORIES
    + RANKS
    + MONTHS
    + counts_view("user_id", "user_counts")
    + counts_view("product_id", "product_counts")
    + f", a1 as (select {figures(RATINGS, 'rating_distribution.')} from interactions)"
    + f", a2 as (select {figures(ACTIVITY, 'user_activity.')} from user_counts)"
    + f", a3 as (select {figures(ACTIVITY, 'product_activity.')} from product_counts)"
    + f", a4 as ({TRENDS})"
    + f", a5 as (select {figures(SPARSITY, 'sparsity.')} from size)"
    + f", a6 as (select {figures(IMPACT, 'filter_impact.')} from interactions)"
    + ", a7 as (select count(*) as n_categories from category_counts)"
    + f", a8 as (select {figures(CORRELATION, 'rating_activity_correlation.')})"
    + " select * from a1, a2, a3, a4, a5, a6, a7, a8"
)


def _flat_summary(record):
    """The figures of the nested record side by side."""
    groups = {
        "rating_distribution": RATINGS,
        "user_activity": ACTIVITY,
        "product_activity": ACTIVITY,
        "sparsity": SPARSITY,
        "filter_impact": IMPACT,
        "rating_activity_correlation": CORRELATION,
    }
    flat = [
        rounded(f"{group}.{name}", alias=f"{group}.{name}")
        for group, names in groups.items()
        for name in names
    ]
    return record.select(*flat, "temporal_trends.*", "categories.n_categories")


@query(sql(SUMMARY_SQL))
def exploration_summary(spark, sf_dir):
    interactions = _built(spark, sf_dir)
    n_raw = views.lines(spark, sf_dir).agg(F.count(F.lit(1)))
    record = summarize(
        interactions, views.products(spark, sf_dir), _users(spark, sf_dir), n_raw
    )
    return _flat_summary(record)


@query(sql(SUMMARY_SQL))
def summary_as_json(spark, sf_dir):
    interactions = _built(spark, sf_dir)
    n_raw = views.lines(spark, sf_dir).agg(F.count(F.lit(1)))
    record = summarize(
        interactions, views.products(spark, sf_dir), _users(spark, sf_dir), n_raw
    )
    path = scratch(spark, "summary")
    sinks.save_summary(record, path)
    return _flat_summary(spark.read.json(path))
