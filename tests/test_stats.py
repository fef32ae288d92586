import numpy as np
import pandas as pd
import pytest
from conftest import N_PRODUCTS, N_RATINGS, N_USERS, rows
from pyspark.sql import functions as F

from tallyrec.operators import distribution, stats, tables
from tallyrec.plans.explore import summarize


@pytest.fixture(scope="module")
def pdf(ratings):
    return ratings.toPandas()


def one(df):
    return df.first().asDict()


def test_ranges_stay_even_with_an_outlier(spark):
    from tallyrec.operators import distribution

    values = spark.range(20_000).select(F.col("id").cast("double").alias("v"))
    values = values.union(spark.createDataFrame([(1e12,)], "v double"))
    counts = distribution.value_counts(values, "v")
    bounds = counts.agg(distribution.range_bounds("value")).scalar()
    sizes = counts.withColumn("b", bounds).groupBy(distribution._range_of(F.col("value"), F.col("b"))).count()
    assert sizes.agg(F.max("count")).first()[0] <= 60
    ranks = distribution.average_ranks(counts)
    assert ranks.where("value = 1e12").first()["rank"] == 20_001
    assert ranks.where("value = 7777").first()["rank"] == 7778


def test_rating_distribution(ratings, pdf):
    r = pdf["rating"]
    found = one(stats.rating_distribution(ratings))
    shares = r.value_counts(normalize=True).sort_index()
    assert dict(tuple(s) for s in found.pop("shares")) == pytest.approx(shares.to_dict())
    expected = {"mean": r.mean(), "median": r.median(), "std": r.std(), "min": r.min(), "max": r.max()}
    expected |= {f"pct_{i}": (r == i).mean() for i in range(1, 6)}
    assert found == pytest.approx(expected)


def test_fractional_ratings_add_up_per_star(spark):
    df = spark.createDataFrame([(4.0,), (4.5,), (5.0,), (None,)], "rating double")
    found = one(stats.rating_distribution(df))
    assert found["pct_4"] == pytest.approx(2 / 3)
    assert found["pct_1"] == 0.0


def test_one_rating_has_no_deviation(spark):
    df = spark.createDataFrame([(4.0,)], "rating double")
    found = one(stats.rating_distribution(df))
    assert (found["median"], found["std"]) == (4.0, None)


@pytest.mark.parametrize("key", ["user_id", "product_id"])
def test_activity_summary(ratings, pdf, key):
    n = pdf.groupby(key)["rating"].count()
    expected = {
        "mean": n.mean(), "median": n.median(), "std": n.std(), "min": n.min(), "max": n.max(),
        **{f"p{q}": n.quantile(q / 100) for q in (25, 75, 95, 99)},
    }
    assert one(stats.activity_summary(ratings, key)) == pytest.approx(expected)


def test_activity_histogram(ratings, pdf):
    counts, edges = np.histogram(pdf.groupby("user_id")["rating"].count(), bins=50)
    found = stats.activity_histogram(ratings, "user_id").toPandas()
    assert found["n"].tolist() == counts.tolist()
    assert found["low"].tolist() == pytest.approx(edges[:-1].tolist())
    assert found["high"].tolist() == pytest.approx(edges[1:].tolist())


def test_histogram_of_equal_counts(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "user_id string, rating double")
    found = stats.activity_histogram(df, "user_id").where("n > 0").first()
    assert (found["bin"], found["n"]) == (25, 2)
    assert found["low"] == pytest.approx(1.0)


def test_boxplot_and_outliers(spark):
    data = [(f"u{i}", 1.0) for i in range(8) for _ in range(2 + i % 3)] + [("big", 1.0)] * 30
    df = spark.createDataFrame(data, "user_id string, rating double")
    n = pd.Series([2 + i % 3 for i in range(8)] + [30])
    box = one(stats.activity_boxplot(df, "user_id"))
    assert [box["q1"], box["median"], box["q3"]] == list(n.quantile([0.25, 0.5, 0.75]))
    assert (box["whisker_low"], box["whisker_high"]) == (2, 4)
    assert (box["n_low_outliers"], box["n_high_outliers"]) == (0, 1)
    assert rows(stats.activity_outliers(df, "user_id")) == [("big", 30)]


def test_exact_quantiles_match_numpy(spark):
    values = np.random.default_rng(1).exponential(10, 500)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    found = one(distribution.exact_quantiles(df, "v", {"a": 0.0, "b": 0.33, "c": 0.5, "d": 1.0}))
    assert list(found.values()) == pytest.approx(list(np.quantile(values, [0, 0.33, 0.5, 1])))


def test_average_ranks_match_pandas(spark):
    values = pd.Series(np.random.default_rng(2).integers(0, 40, 300))
    df = spark.createDataFrame([(int(v),) for v in values], "v int")
    found = distribution.average_ranks(distribution.value_counts(df, "v"))
    assert dict(rows(found)) == dict(zip(values, values.rank()))


def test_temporal_trends(ratings, pdf):
    months = pd.to_datetime(pdf["timestamp"], unit="s").dt.strftime("%Y-%m").value_counts()
    found = one(stats.temporal_trends(ratings))
    best = months[months == months.max()].index.min()
    assert found == {
        "min_date": months.index.min(), "max_date": months.index.max(), "n_months": len(months),
        "peak_month": best, "peak_count": months.max(), "skipped": False,
    }


def test_trends_are_skipped_without_usable_timestamps(ratings):
    assert one(stats.temporal_trends(ratings.drop("timestamp")))["skipped"] is True
    millis = ratings.withColumn("timestamp", F.col("timestamp") * 1000)
    assert one(stats.temporal_trends(millis))["skipped"] is True


def test_sparsity_report_and_heatmap(ratings, pdf):
    found = one(stats.sparsity_report(ratings, 5))
    users = pdf.groupby("user_id")["rating"].count().sort_index().nlargest(5).index
    products = pdf.groupby("product_id")["rating"].count().sort_index().nlargest(5).index
    table = pdf.pivot_table(index="user_id", columns="product_id", values="rating", aggfunc="mean")
    table = table.reindex(index=users, columns=products)
    assert found["sample_sparsity"] == pytest.approx(1 - table.notna().values.mean())
    assert found["density"] == pytest.approx(N_RATINGS / (N_USERS * N_PRODUCTS))
    grid = stats.interaction_heatmap(ratings, 5)
    assert grid.count() == 25
    assert grid.agg(F.sum("has_interaction")).first()[0] == table.notna().values.sum()
    wide = stats.top_rating_matrix(ratings, 5, 5).toPandas().set_index("user_id")
    assert wide.index.tolist() == users.tolist()
    assert wide.columns.tolist() == products.tolist()
    assert np.allclose(wide.values.astype(float), table.values, equal_nan=True)


def test_heatmap_plan_has_no_cross_join(ratings):
    plan = stats.interaction_heatmap(ratings)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filter_impact(spark, ratings):
    n_raw = spark.range(1).select(F.lit(2 * N_RATINGS).alias("n"))
    assert one(stats.filter_impact(n_raw, ratings)) == {
        "n_raw": 2 * N_RATINGS, "n_processed": N_RATINGS, "pct_retained": 50.0, "n_dropped": N_RATINGS,
    }
    none = spark.range(1).select(F.lit(0).alias("n"))
    assert one(stats.filter_impact(none, ratings))["pct_retained"] == 0.0


def test_categories(spark, ratings):
    products = spark.createDataFrame(
        [("p0", "a"), ("p0", "a"), ("p1", "b"), ("unseen", "c"), ("p2", None)],
        "product_id string, category string",
    )
    n = {r["product_id"]: r["n"] for r in stats.activity_counts(ratings, "product_id").collect()}
    expected = [("a", 2, 2 * n["p0"]), ("b", 1, n["p1"]), ("c", 1, 0)]
    expected.sort(key=lambda row: (-row[2], row[0]))
    found = stats.category_stats(products, ratings, 2).first()
    assert found["n_categories"] == 3
    assert [tuple(entry) for entry in found["top_categories"]] == expected[:2]
    assert stats.category_stats(products.drop("category"), ratings).first()["skipped"] is True


def test_correlations_match_pandas(ratings):
    users = tables.build_users(ratings)
    pdf = users.toPandas()
    found = one(stats.rating_activity_correlation(users))
    x, y = pdf["total_reviews"], pdf["avg_rating"].astype(float)
    assert found["pearson_r"] == pytest.approx(x.corr(y))
    assert found["spearman_r"] == pytest.approx(x.rank().corr(y.rank()))


def test_correlation_of_a_constant_is_null(spark):
    users = spark.createDataFrame([("a", 3, 1.0), ("b", 3, 2.0)], "user_id string, total_reviews int, avg_rating float")
    assert one(stats.rating_activity_correlation(users)) == {"pearson_r": None, "spearman_r": None}


def test_rating_bins_keep_every_user(ratings):
    users = tables.build_users(ratings)
    found = stats.activity_rating_bins(users)
    assert found.agg(F.sum("n"), F.max("x_bin"), F.max("y_bin")).first()[:] == (N_USERS, 39, 39)


def test_summary_of_empty_tables(spark, ratings):
    empty = ratings.where("false")
    products = spark.createDataFrame([], "product_id string, category string")
    n_raw = spark.range(1).select(F.lit(0).alias("n"))
    found = summarize(empty, products, tables.build_users(empty), n_raw).first()
    assert found["rating_distribution"] is None
    assert found["temporal_trends"]["skipped"] is True
    assert found["sparsity"]["sparsity"] == 1.0
    assert found["rating_activity_correlation"]["pearson_r"] is None
