import numpy as np
import pytest
from conftest import N_PRODUCTS, N_USERS, rows, unit_vectors
from pyspark.sql import functions as F

from tallyrec.operators import factor, lanczos
from tallyrec.plans import recommend
from tallyrec.plans.recommend import HybridRecommender, SvdRecommender
from tallyrec.plans.serve import recommend_batch, rejected


def predicted(pdf, k):
    """Scores of every user and product by a full decomposition."""
    users, products = sorted(pdf["user_id"].unique()), sorted(pdf["product_id"].unique())
    matrix = np.zeros((len(users), len(products)))
    stored = np.zeros_like(matrix, dtype=bool)
    for r in pdf.itertuples():
        at = users.index(r.user_id), products.index(r.product_id)
        matrix[at] += r.rating
        stored[at] = True
    means = matrix.mean(axis=1)
    centred = np.where(stored, matrix - means[:, None], 0)
    u, s, vt = np.linalg.svd(centred, full_matrices=False)
    scores = (u[:, :k] * s[:k]) @ vt[:k] + means[:, None]
    low, high = scores.min(axis=1, keepdims=True), scores.max(axis=1, keepdims=True)
    return users, products, (scores - low) / (high - low)


@pytest.fixture(scope="module")
def model(ratings):
    return SvdRecommender(n_factors=5).fit(ratings)


@pytest.fixture(scope="module")
def users(ratings):
    return ratings.select("user_id").distinct()


def check_against_numpy(model, ratings, k):
    users, products, expected = predicted(ratings.toPandas(), k)
    found = model.recommend(ratings.select("user_id").distinct(), 1000).collect()
    assert len(found) == expected.size
    for r in found:
        assert r["score"] == pytest.approx(
            expected[users.index(r["user_id"]), products.index(r["product_id"])], abs=1e-6
        )


def test_scores_match_numpy(model, ratings):
    check_against_numpy(model, ratings, 5)


def test_too_many_products_for_the_driver_are_an_error_at_once():
    with pytest.raises(ValueError, match="the budget is 1 MB"):
        factor.check_solver_budget(100_000, 50, 1 << 20)
    factor.check_solver_budget(100, 50, 1 << 20)


@pytest.mark.parametrize("limit", ["SOLVER_CELLS", "SOLVER_BYTES"])
def test_matrices_beyond_the_driver_are_solved_in_a_task(ratings, monkeypatch, limit):
    monkeypatch.setattr(factor, limit, 0)
    monkeypatch.setattr(factor, "_right_basis", None)
    monkeypatch.setattr(factor, "ROWS_OUT", 10)
    for k in (5, 500):
        large = SvdRecommender(n_factors=k).fit(ratings)
        assert large.user_factors.count() == N_USERS and large.item_factors.count() == N_PRODUCTS
        check_against_numpy(large, ratings, min(k, N_USERS - 1))


@pytest.mark.parametrize("in_files", [True, False])
def test_leading_vectors_of_a_sparse_matrix(monkeypatch, in_files):
    monkeypatch.setattr(lanczos, "CELLS", 50)
    if in_files:
        monkeypatch.setattr(lanczos, "FILE_BYTES", 1)
    rng = np.random.default_rng(4)
    one = np.where(rng.random((70, 90)) < 0.1, rng.standard_normal((70, 90)), 0)
    one[np.arange(70), np.arange(70)] = one[0, 70:] = 1.0
    # three equal blocks: every singular value comes three times
    for dense in (one, np.kron(np.eye(3), one), np.eye(6) * [3, 3, 2, 2, 2, 0.1], np.ones((4, 5))):
        lengths, (_, columns) = (dense != 0).sum(axis=1), dense.nonzero()
        matrix = lanczos.SparseMatrix(lengths, columns.astype(np.int32), dense[dense != 0], dense.shape[1])
        x = rng.standard_normal(dense.shape[1])
        assert matrix.gram_times(x) == pytest.approx(dense.T @ (dense @ x))
        assert matrix.times(np.stack([x, -x], axis=1), slice(2, 4)) == pytest.approx(dense[2:4] @ np.stack([x, -x], axis=1))
        k = min(7, *dense.shape) - 1 if len(dense) < 10 else 7
        found, vectors = lanczos.leading_vectors(matrix.gram_times, dense.shape[1], k)
        assert found == pytest.approx(np.linalg.svd(dense)[1][:k] ** 2, abs=1e-9)
        assert vectors @ vectors.T == pytest.approx(np.eye(k), abs=1e-10)
        assert vectors @ dense.T @ dense == pytest.approx(found[:, None] * vectors, abs=1e-8)


def test_no_row_passes_through_python_on_the_way_to_the_solver(spark, ratings):
    cells = factor.rating_cells(ratings)
    items = factor.dense_index(cells, "product_id", "item_idx")
    rows_ = factor.centred_rows(cells, items, N_PRODUCTS)
    vectors = factor.sparse_vectors(rows_, N_PRODUCTS)
    for df in (rows_, vectors):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
    entries = {(r["user_id"], i): v for r in rows_.collect() for i, v in zip(r["indices"], r["values"])}
    assert sum(len(r["row"].indices) for r in vectors.collect()) == len(entries)


def test_a_missing_id_gets_the_popular_list(spark, model, hybrid):
    wanted = spark.createDataFrame([(None,), ("nobody",)], "user_id string")
    for answer in (model.recommend(wanted, 4), hybrid.recommend(wanted, 4)):
        found = {}
        for r in answer.orderBy("rank").collect():
            found.setdefault(r["user_id"], []).append((r["product_id"], r["score"]))
        assert len(found[None]) == 4 and found[None] == found["nobody"]


def test_factors_are_capped(ratings):
    model = SvdRecommender(n_factors=500).fit(ratings)
    assert model.user_factors.agg(F.max(F.size("vector"))).first()[0] <= N_USERS - 1


def test_one_product_cannot_be_factorized(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 2.0)], "user_id string, product_id string, rating double")
    with pytest.raises(ValueError, match="two"):
        SvdRecommender().fit(df)


def test_lists_are_ranked_unique_and_scaled(model, users):
    found = model.recommend(users, 7).toPandas().sort_values(["user_id", "rank"])
    for _, part in found.groupby("user_id"):
        assert part["rank"].tolist() == list(range(1, 8))
        assert part["score"].is_monotonic_decreasing
        assert part["score"].between(0, 1).all()
        assert part["product_id"].is_unique
        assert part["score"].iloc[0] == 1.0


def test_unknown_users_get_popular_products(spark, model, ratings):
    counts = ratings.groupBy("product_id").count().toPandas()
    best = counts.sort_values(["count", "product_id"], ascending=[False, True])["product_id"][:4]
    unknown = spark.createDataFrame([("nobody", 4), ("none", 2)], "user_id string, k int")
    found = model.recommend(unknown, "k").orderBy("user_id", "rank").collect()
    assert [(r["user_id"], r["product_id"], r["score"]) for r in found] == [
        *(("nobody", p, 0.0) for p in best), *(("none", p, 0.0) for p in best[:2]),
    ]


def test_depth_per_user_and_clamping(spark, model):
    wanted = spark.createDataFrame([("u1", 3), ("u2", 0), ("u3", 9999)], "user_id string, k int")
    counts = {r["user_id"]: r["count"] for r in model.recommend(wanted, "k").groupBy("user_id").count().collect()}
    assert counts["u1"] == 3 and counts["u2"] == 1
    assert counts["u3"] == model.item_factors.count()


def test_evaluation(model, ratings):
    found = model.evaluate(ratings).first().asDict()
    assert set(found) == {"precision_at_10", "recall_at_10", "ndcg_at_10", "mrr"}
    assert all(0 < value <= 1 for value in found.values())
    assert set(model.evaluate(ratings.where("false")).first()) == {0.0}


def test_unfitted_models_say_so(users):
    for call in (lambda m: m.recommend(users), lambda m: m.evaluate(users), lambda m: m.save("/tmp/x")):
        with pytest.raises(RuntimeError, match="fit"):
            call(SvdRecommender())


def test_saved_model_gives_the_same_answers(spark, model, users, folder):
    model.save(f"{folder}/svd")
    loaded = SvdRecommender.load(spark, f"{folder}/svd")
    assert (loaded.n_factors, loaded.random_state) == (5, 42)
    assert rows(loaded.recommend(users)) == rows(model.recommend(users))


def test_dense_index_has_no_gaps(spark):
    ids = spark.range(5000).select((F.col("id") % 3000).cast("string").alias("key"))
    index = factor.dense_index(ids, "key", "n")
    low, high, n, distinct = index.agg(F.min("n"), F.max("n"), F.count("n"), F.count_distinct("n")).first()
    assert (low, high, n, distinct) == (0, 2999, 3000, 3000)
    assert rows(index) == rows(factor.dense_index(ids.repartition(7), "key", "n"))


# --- hybrid --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def hybrid(spark, model):
    # vectors for p0..p24 only: some seeds are unknown to the index
    return HybridRecommender.build(model, spark.createDataFrame(unit_vectors(25, 16, "p", 42)), ["product_id"])


def fuse_by_hand(hybrid, user, k, spark):
    one = spark.createDataFrame([(user,)], "user_id string")
    cf = hybrid.cf.recommend(one, 3 * k).orderBy("rank").collect()
    seed = spark.createDataFrame([(cf[0]["product_id"],)], "product_id string")
    similar = hybrid._index.similar_products(seed, 3 * k).orderBy("rank").collect()
    scores = {r["product_id"]: hybrid.alpha * r["score"] for r in cf}
    for r in similar:
        scores[r["product_id"]] = scores.get(r["product_id"], 0.0) + (1 - hybrid.alpha) * r["score"]
    ranked = sorted(scores.items(), key=lambda item: -item[1])[:k]
    return [(p, pytest.approx(s, abs=6e-5)) for p, s in ranked]


@pytest.mark.parametrize("user", ["u0", "u7", "nobody"])
def test_hybrid_lists(spark, hybrid, user):
    wanted = spark.createDataFrame([(user,), ("u3",)], "user_id string")
    found = hybrid.recommend(wanted, 5).where(F.col("user_id") == user).orderBy("rank").collect()
    assert [(r["product_id"], r["score"]) for r in found] == fuse_by_hand(hybrid, user, 5, spark)


def test_hot_seeds_give_the_same_lists(spark, hybrid, users, monkeypatch):
    # all unknown users share the seed of the most popular product
    visitors = spark.range(60).select(F.concat(F.lit("v"), "id").alias("user_id"))
    wanted = users.union(visitors)
    salted = rows(hybrid.recommend(wanted, 4))
    monkeypatch.setattr(recommend, "HOT_SHARE", 2.0)
    assert rows(hybrid.recommend(wanted, 4)) == salted


def test_rank_fusion_strategy(spark, model, hybrid, users):
    other = HybridRecommender(model, hybrid.vectors, strategy="rank_fusion")
    top = other.recommend(users, 3)
    assert top.groupBy("user_id").count().select("count").distinct().collect() == [(3,)]
    assert top.agg(F.max("score")).first()[0] <= 2 / 61 + 1e-6


def test_tuning_sets_alpha(spark, model, hybrid, ratings):
    tuned = HybridRecommender(model, hybrid.vectors, alpha=0.9)
    scores = tuned.tuning_scores(ratings, k=5).collect()
    assert len(scores) == 6
    best = max(scores, key=lambda r: (r["ndcg"], -r["position"]))
    assert tuned.tune_alpha(ratings, k=5) == best["alpha"] == tuned.alpha


def test_tuning_without_judges_keeps_alpha(model, hybrid, ratings):
    tuned = HybridRecommender(model, hybrid.vectors, alpha=0.9)
    assert tuned.tune_alpha(ratings.where("rating < 4")) == 0.9


def test_hybrid_round_trip(spark, hybrid, users, folder):
    hybrid.save(f"{folder}/hybrid")
    loaded = HybridRecommender.load(spark, f"{folder}/hybrid")
    assert (loaded.alpha, loaded.strategy, loaded.version) == (0.6, "weighted", "1.0.0")
    assert rows(loaded.recommend(users, 4)) == rows(hybrid.recommend(users, 4))


def test_batch_of_requests(spark, hybrid):
    asked = spark.createDataFrame(
        [(1, "u1", 2), (2, "u1", 6), (3, "u1", 2), (4, "nobody", 3), (5, "", 3), (6, None, 3),
         (7, "u2", 0), (8, "u2", 101), (9, "u2", None), (10, "u2", 100)],
        "id int, user_id string, top_k int",
    )
    responses = recommend_batch(hybrid, asked)
    found = {r["id"]: r for r in responses.collect()}
    assert len(found) == 10
    assert {i for i, r in found.items() if r["status"] == "invalid"} == {5, 6, 7, 8}
    lengths = {i: len(r["recommendations"]) for i, r in found.items() if r["status"] == "ok"}
    assert lengths == {1: 2, 2: 6, 3: 2, 4: 3, 9: 10, 10: N_PRODUCTS}
    assert found[1]["recommendations"] == found[3]["recommendations"]
    alone = hybrid.recommend(spark.createDataFrame([("u1",)], "user_id string"), 6).orderBy("rank")
    assert [(r["product_id"], r["score"]) for r in found[2]["recommendations"]] == [
        (r["product_id"], r["score"]) for r in alone.collect()
    ]
    assert found[1]["model_version"] == "1.0.0"
    assert rows(rejected(responses), "id", "reason") == [
        (5, "user_id is empty"), (6, "user_id is empty"),
        (7, "top_k is below 1"), (8, "top_k is above 100"),
    ]


def test_requests_without_top_k_get_ten(spark, hybrid):
    asked = spark.createDataFrame([("u1",)], "user_id string")
    assert len(recommend_batch(hybrid, asked).first()["recommendations"]) == 10


def test_candidates_are_exchanged_once_by_user(spark, hybrid, users):
    wanted = users.select("user_id", F.explode(F.array(F.lit(3), F.lit(7))).alias("top_k"))
    lists = hybrid.recommend_lists(wanted)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    by_user = [line for line in plan.splitlines() if "Exchange hashpartitioning(user_id" in line]
    # nothing is exchanged after the candidates; the others move ids of users and seeds alone
    assert ["REPARTITION_BY_COL" in line for line in by_user].index(True) == 0
    assert sum("REPARTITION_BY_COL" in line for line in by_user) == 1
    found = {(r["user_id"], r["top_k"]): r["products"] for r in lists.collect()}
    alone = hybrid.recommend(users, 7).orderBy("user_id", "rank").collect()
    assert [(r["product_id"], r["score"]) for r in alone if r["user_id"] == "u4"] == [tuple(p) for p in found["u4", 7]]
    assert all(len(products) == top_k for (_, top_k), products in found.items())
