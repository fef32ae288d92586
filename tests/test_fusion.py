import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyrec.operators import fusion, metrics

CF = [("ale", 0.92), ("bun", 0.61), ("cod", 0.44), ("dip", 0.13)]
SEMANTIC = [("dip", 0.97), ("bun", 0.58), ("egg", 0.52), ("fig", 0.21), ("gum", 0.06)]


def candidates(spark, items, user="u1"):
    return spark.createDataFrame(
        [(user, p, s, i) for i, (p, s) in enumerate(items, 1)],
        "user_id string, product_id string, score double, rank int",
    )


def result(df):
    return [(r["product_id"], r["score"]) for r in df.orderBy("rank").collect()]


def test_weighted_scores(spark):
    fused = fusion.weighted_fusion(candidates(spark, CF), candidates(spark, SEMANTIC), 10, 0.6)
    scores = dict(result(fused))
    # by hand: 0.6 * collaborative + 0.4 * semantic
    assert result(fused) == [
        ("bun", 0.598), ("ale", 0.552), ("dip", 0.466), ("cod", 0.264),
        ("egg", 0.208), ("fig", 0.084), ("gum", 0.024),
    ]
    assert scores["bun"] == pytest.approx(0.6 * 0.61 + 0.4 * 0.58)


@pytest.mark.parametrize(("alpha", "source"), [(1.0, CF), (0.0, SEMANTIC)])
def test_extreme_weights_follow_one_list(spark, alpha, source):
    fused = fusion.weighted_fusion(candidates(spark, CF), candidates(spark, SEMANTIC), 4, alpha)
    assert result(fused) == source[:4]


def test_ties_put_collaborative_candidates_first(spark):
    cf, semantic = [("b", 0.5), ("a", 0.5)], [("d", 0.5), ("c", 0.5)]
    fused = fusion.weighted_fusion(candidates(spark, cf), candidates(spark, semantic), 4, 0.5)
    assert [p for p, _ in result(fused)] == ["b", "a", "d", "c"]


def test_rank_fusion(spark):
    fused = fusion.rank_fusion(candidates(spark, CF), candidates(spark, SEMANTIC), 10)
    scores = dict(result(fused))
    assert scores["dip"] == pytest.approx(1 / 64 + 1 / 61, abs=1e-6)
    assert scores["ale"] == pytest.approx(1 / 61, abs=1e-6)
    assert scores["gum"] == pytest.approx(1 / 65, abs=1e-6)
    assert [p for p, _ in result(fused)][:2] == ["bun", "dip"]


def test_one_shuffle_serves_grouping_and_ranking(spark):
    fused = fusion.rank_fusion(candidates(spark, CF), candidates(spark, SEMANTIC), 10)
    plan = fused._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_empty_semantic_list(spark):
    fused = fusion.weighted_fusion(candidates(spark, CF), candidates(spark, []), 3)
    assert [p for p, _ in result(fused)] == ["ale", "bun", "cod"]


def tuning(spark, relevant, alphas, weighted=True):
    users = spark.createDataFrame([("u1",)], "user_id string")
    wanted = users.select("user_id", F.explode(F.array(*map(F.lit, relevant))).alias("product_id"))
    return fusion.alpha_scores(
        candidates(spark, CF), candidates(spark, SEMANTIC), wanted, users, alphas, 3, weighted
    )


def test_tuning_prefers_the_better_weight(spark):
    scores = tuning(spark, ["egg", "dip"], [1.0, 0.0, 0.5])
    assert fusion.best_alpha(scores).first()["alpha"] == 0.0
    assert [r["alpha"] for r in scores.collect()] == [1.0, 0.0, 0.5]


def test_first_weight_wins_a_tie(spark):
    scores = tuning(spark, ["cod"], [0.7, 0.3], weighted=False)
    assert len({r["ndcg"] for r in scores.collect()}) == 1
    assert fusion.best_alpha(scores).first()["alpha"] == 0.7


def test_tuning_users(spark):
    ratings = spark.createDataFrame(
        [(f"u{i}", "p", 5.0 if i % 2 else 3.0) for i in range(9)], "user_id string, product_id string, rating double"
    )
    assert rows(fusion.tuning_users(ratings)) == [("u1",), ("u3",), ("u5",), ("u7",)]
    assert rows(fusion.tuning_users(ratings, 2)) == [("u1",), ("u3",)]


def many_users(spark, n=60):
    """Lists of several users, which share nothing but the products."""
    names = "abcdefghij"
    cf, semantic, wanted = [], [], []
    for u in range(n):
        for i in range(6):
            cf.append((f"u{u}", names[(u + i) % 10], (u * 7 + i * 3) % 11 / 11, i + 1))
            semantic.append((f"u{u}", names[(u * 3 + i) % 10], (u * 5 + i) % 13 / 13, i + 1))
        wanted += [(f"u{u}", names[(u * u + j) % 10]) for j in range(u % 4)]
    schema = "user_id string, product_id string, score double, rank int"
    lists = [spark.createDataFrame(rows_, schema) for rows_ in (cf, semantic)]
    users = spark.createDataFrame([(f"u{u}",) for u in range(n)] + [("nobody",)], "user_id string")
    return *lists, spark.createDataFrame(wanted, "user_id string, product_id string"), users


def test_scores_do_not_depend_on_the_order_of_the_users(spark):
    cf, semantic, wanted, users = many_users(spark)
    # 0.5 twice: a tie that any difference in the last bit would decide
    alphas = (0.2, 0.5, 0.5, 0.8)
    found = set()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in range(1, 21):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            shuffled = [df.repartition(n, F.rand(n)) for df in (cf, semantic, wanted, users)]
            scores = fusion.alpha_scores(*shuffled, alphas, 4)
            found.add(tuple(r["ndcg"] for r in scores.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == 1
    (ndcg,) = found
    assert ndcg[1] == ndcg[2] and len(set(ndcg)) == 3


@pytest.mark.parametrize("weighted", [True, False])
def test_weights_are_judged_as_the_fused_lists_are(spark, weighted):
    cf, semantic, wanted, users = many_users(spark, 25)
    scores = fusion.alpha_scores(cf, semantic, wanted, users, (0.3, 0.9), 4, weighted).collect()
    for row in scores:
        fused = (
            fusion.weighted_fusion(cf, semantic, 4, row["alpha"])
            if weighted
            else fusion.rank_fusion(cf, semantic, 4)
        )
        per_user = metrics.user_metrics(fused, wanted, 4, users)
        assert row["ndcg"] == pytest.approx(metrics.mean_metrics(per_user).first()["ndcg_at_10"], abs=1e-11)


def test_candidates_move_once_to_be_tuned(spark):
    cf, semantic, wanted, users = many_users(spark, 5)
    plan = fusion.alpha_scores(cf, semantic, wanted, users)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id#") == 3  # the candidates; distinct pairs and users
    assert plan.count("REPARTITION_BY_COL") == 1


def test_best_weight_of_equal_means_is_the_first(spark):
    scores = spark.createDataFrame(
        [(0, 0.3, 0.5), (1, 0.9, 0.75), (2, 0.1, 0.75)], "position int, alpha double, ndcg double"
    )
    assert fusion.best_alpha(scores.repartition(3)).first()["alpha"] == 0.9
