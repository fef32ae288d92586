import pytest
from conftest import rows

from tallyrec.operators import cleaning, tables
from tallyrec.plans.prepare import prepare
from tallyrec.session import exists, workspace


def reviews(spark, *data, rating="double"):
    return spark.createDataFrame(
        [(i, *row) for i, row in enumerate(data)],
        f"seq int, user_id string, product_id string, rating {rating}",
    )


def test_first_row_wins_and_nulls_are_equal(spark):
    df = reviews(spark, ("a", "x", 1.0), (None, "x", 2.0), ("a", "x", 3.0), (None, "x", 4.0))
    kept = cleaning.remove_duplicates(df, ["user_id", "product_id"], ["seq"])
    assert rows(kept, "seq") == [(0,), (1,)]


def test_duplicates_of_a_hot_key_are_cut_before_the_shuffle(spark):
    df = reviews(spark, ("a", "x", 1.0))
    kept = cleaning.remove_duplicates(df, ["user_id", "product_id"], ["seq"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_duplicate_whose_first_row_is_invalid_loses_both(spark):
    df = reviews(spark, ("a", "x", None), ("a", "x", 5.0), ("b", "x", 9.0), ("b", "x", 4.0))
    prepared = prepare(df, min_user_reviews=1, min_product_reviews=1, order_by=["seq"])
    assert rows(prepared.interactions) == []
    assert prepared.stage_counts.first().asDict() == {
        "raw": 4, "deduplicated": 2, "complete": 1, "valid_rating": 0, "cold_start": 0,
    }


def test_unreadable_rating_counts_as_rating_drop(spark):
    df = reviews(spark, ("a", "x", "four"), ("a", "y", "4"), rating="string")
    prepared = prepare(df, min_user_reviews=1, min_product_reviews=1, order_by=["seq"])
    counts = prepared.stage_counts.first()
    assert (counts["complete"], counts["valid_rating"]) == (2, 1)


def test_numeric_ids_match_metadata(spark):
    df = spark.createDataFrame([(0, 1, 7, 5.0)], "seq int, user_id int, product_id int, rating double")
    meta = spark.createDataFrame([("7", "lamp"), ("8", "desk")], "product_id string, title string")
    prepared = prepare(df, meta, 1, 1, ["seq"])
    assert rows(prepared.products, "product_id", "title") == [("7", "lamp")]


def test_valid_ratings_are_inclusive(spark):
    df = reviews(spark, ("a", "x", 1.0), ("a", "y", 5.0), ("a", "z", 0.9), ("a", "w", float("nan")))
    assert rows(cleaning.keep_valid_ratings(df), "product_id") == [("x",), ("y",)]


def brute_force(pairs, min_user, min_product):
    dropped = [0, 0]
    trace = []
    while True:
        trace.append(len(pairs))
        for side, least in ((0, min_user), (1, min_product)):
            counts = {}
            for pair in pairs:
                counts[pair[side]] = counts.get(pair[side], 0) + 1
            kept = [p for p in pairs if p[side] is not None and counts[p[side]] >= least]
            dropped[side] += len(pairs) - len(kept)
            pairs = kept
        if len(pairs) == trace[-1]:
            return pairs, dropped, trace


@pytest.mark.parametrize("thresholds", [(5, 10), (9, 7), (12, 9), (1, 1)])
def test_cold_start_matches_brute_force(spark, ratings, thresholds):
    pairs = [(r["user_id"], r["product_id"]) for r in ratings.collect()]
    kept, dropped, trace = brute_force(pairs, *thresholds)
    result = cleaning.filter_cold_start(ratings, *thresholds)
    assert rows(result.interactions, "user_id", "product_id") == sorted(kept, key=repr)
    assert [result.user_rows_dropped, result.product_rows_dropped] == dropped
    assert result.rows_per_pass == trace


@pytest.mark.parametrize("max_parts", [1, 8])
def test_cold_start_with_many_passes_and_missing_ids(spark, monkeypatch, max_parts):
    monkeypatch.setattr(cleaning, "MAX_PARTS", max_parts)
    # a chain that unravels one end per half pass, and rows without ids
    pairs = [(f"u{i}", f"p{j}") for i in range(12) for j in (i, i + 1)]
    pairs += [(None, "p3"), ("u4", None)] + [("v", "q")] * 3
    df = spark.createDataFrame(pairs, "user_id string, product_id string")
    kept, dropped, trace = brute_force(pairs, 2, 2)
    result = cleaning.filter_cold_start(df, 2, 2)
    assert rows(result.interactions) == sorted(kept, key=repr)
    assert [result.user_rows_dropped, result.product_rows_dropped] == dropped
    assert result.rows_per_pass == trace


def test_stage_counts_read_the_raw_input_once(spark, folder):
    reviews(spark, ("a", "x", 1.0), ("a", "x", 2.0), ("b", "y", None)).write.parquet(f"{folder}/raw")
    raw = spark.read.parquet(f"{folder}/raw")
    prepared = prepare(raw, None, 1, 1, ["seq"])
    assert prepared.stage_counts.first().asDict() == {
        "raw": 3, "deduplicated": 2, "complete": 1, "valid_rating": 1, "cold_start": 1,
    }
    plan = prepared.stage_counts._jdf.queryExecution().executedPlan().toString()
    assert f"{folder}/raw" not in plan
    assert prepare(raw.limit(0), None, 1, 1, ["seq"]).stage_counts.first()["raw"] == 0


def test_a_workspace_leaves_nothing_behind(spark):
    df = reviews(spark, *[(f"u{i % 7}", f"p{i % 5}", 4.0) for i in range(60)])
    with workspace(spark) as path:
        prepared = prepare(df, None, 2, 2, ["seq"])
        assert prepared.interactions.count() == 35
        assert exists(spark, path)
    assert not exists(spark, path)


def test_milliseconds(spark):
    df = spark.createDataFrame([("a", "x", 1.0, 1_600_000_000_999)], "user_id string, product_id string, rating double, timestamp long")
    assert tables.build_interactions(df, "ms").first()["timestamp"] == 1_600_000_000
    with pytest.raises(ValueError, match="unit"):
        tables.build_interactions(df, "us")


def test_products_without_metadata_vanish_and_repeated_ones_stay(spark):
    df = reviews(spark, ("a", "x", 1.0), ("a", "y", 1.0))
    meta = spark.createDataFrame(
        [("x", "1.5"), ("x", "free"), ("z", "2")], "product_id string, price string"
    )
    built = tables.build_products(df, meta)
    assert rows(built, "product_id", "price") == [("x", 1.5), ("x", None)]
    assert built.columns == ["product_id", "title", "description", "category", "price"]


def test_interactions_types(spark):
    built = tables.build_interactions(reviews(spark, ("a", "x", 1.0)))
    assert dict(built.dtypes) == {
        "user_id": "string", "product_id": "string", "rating": "float", "timestamp": "bigint",
    }
    assert built.first()["timestamp"] is None


def test_users_count_non_null_ratings(spark):
    df = reviews(spark, ("a", "x", 1.0), ("a", "y", None), ("a", "z", 4.0), ("b", "x", None))
    assert rows(tables.build_users(df)) == [("a", 2, 2.5), ("b", 0, None)]
