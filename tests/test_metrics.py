import pytest
from pyspark.sql import functions as F

from tallyrec.operators import metrics

# A list of letters against a set of letters, worked out by hand. A hit at rank r gains 1 / log2(r + 1):
# 1, 0.63093, 0.5, 0.43068, 0.38685.
CASES = [
    # recommended, relevant, k, precision, recall, ndcg
    ("mnop", "npq", 4, 0.5, 2 / 3, (0.63093 + 0.43068) / (1 + 0.63093 + 0.5)),
    ("stuvw", "w", 5, 0.2, 1, 0.38685),
    ("stuvw", "w", 4, 0, 0, 0),
    ("kl", "lk", 5, 0.4, 1, 1),
    ("qrs", "tsrqu", 2, 1, 0.4, 1),
    ("hgfe", "eh", 4, 0.5, 1, (1 + 0.43068) / (1 + 0.63093)),
    ("ghij", "kl", 3, 0, 0, 0),
    ("", "ef", 3, 0, 0, 0),
    ("ef", "", 3, 0, 0, 0),
    ("ef", "f", 0, 0, 0, 0),
]


def lists(spark, recommended, relevant):
    found = spark.createDataFrame(
        [("u", p, i) for i, p in enumerate(recommended, 1)], "user_id string, product_id string, rank int"
    )
    wanted = spark.createDataFrame([("u", p) for p in relevant], "user_id string, product_id string")
    return found, wanted, spark.createDataFrame([("u",)], "user_id string")


@pytest.mark.parametrize("case", CASES)
def test_cut_metrics(spark, case):
    recommended, relevant, k, *expected = case
    found, wanted, users = lists(spark, recommended, relevant)
    row = metrics.user_metrics(found, wanted, k, users).first()
    for name, value in zip(("precision", "recall", "ndcg"), expected):
        assert row[name] == pytest.approx(value, abs=1e-5)


@pytest.mark.parametrize(
    ("recommended", "relevant", "value"),
    [("dcba", "b", 1 / 3), ("dcba", "ad", 1), ("dcba", "ca", 1 / 2), ("dcba", "a", 1 / 4),
     ("d", "e", 0), ("", "e", 0), ("de", "", 0)],
)
def test_mrr_looks_at_the_whole_list(spark, recommended, relevant, value):
    found, wanted, users = lists(spark, recommended, relevant)
    assert metrics.user_metrics(found, wanted, 1, users).first()["mrr"] == pytest.approx(value)


def test_repeated_relevant_rows_count_once(spark):
    found, wanted, _ = lists(spark, "ab", "aab")
    assert metrics.user_metrics(found, wanted, 2).first()["recall"] == 1.0


def test_means_without_users_are_zero(spark, ratings):
    none = metrics.relevant_products(ratings.where("false"))
    empty = none.withColumn("rank", F.lit(1))
    assert metrics.mean_metrics(metrics.user_metrics(empty, none)).first().asDict() == {
        "precision_at_10": 0.0, "recall_at_10": 0.0, "ndcg_at_10": 0.0, "mrr": 0.0,
    }
