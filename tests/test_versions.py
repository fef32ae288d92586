import pytest
from conftest import rows, unit_vectors
from pyspark.sql import functions as F

from tallyrec.plans.recommend import HybridRecommender, SvdRecommender
from tallyrec.session import create_file, list_names
from tallyrec.sources import readers, sinks, versions


@pytest.fixture(scope="module")
def svd(ratings):
    return SvdRecommender(n_factors=4).fit(ratings)


@pytest.fixture(scope="module")
def users(ratings):
    return ratings.select("user_id").distinct()


def hybrid_of(spark, svd, **settings):
    vectors = spark.createDataFrame(unit_vectors(25, 16, "p", 42))
    return HybridRecommender.build(svd, vectors, ["product_id"], **settings)


def test_a_loaded_model_is_tuned_and_saved_in_place(spark, svd, ratings, users, folder):
    path = f"{folder}/hybrid"
    hybrid_of(spark, svd, alpha=0.9).save(path)
    loaded = HybridRecommender.load(spark, path)
    before = rows(loaded.recommend(users, 3))
    weight = loaded.tune_alpha(ratings, k=5)
    assert weight != 0.9
    loaded.save(path)
    assert HybridRecommender.load(spark, path).alpha == weight
    # the model in hand, and one that was opened before, go on working
    loaded.alpha = 0.9
    assert rows(loaded.recommend(users, 3)) == before
    loaded.save(path)
    again = HybridRecommender.load(spark, path)
    assert again.alpha == 0.9 and rows(again.recommend(users, 3)) == before


def test_an_svd_model_is_saved_in_place(spark, svd, users, folder):
    expected = rows(svd.recommend(users, 3))
    svd.save(folder)
    for _ in range(2):
        loaded = SvdRecommender.load(spark, folder)
        loaded.save(folder)
    assert rows(SvdRecommender.load(spark, folder).recommend(users, 3)) == expected
    assert versions.drop_old_versions(spark, folder) == 2
    assert rows(SvdRecommender.load(spark, folder).recommend(users, 3)) == expected
    assert len(list_names(spark, f"{folder}/versions")) == 1


def test_a_save_that_is_cut_off_changes_nothing(spark, svd, users, folder):
    expected = rows(svd.recommend(users, 3))
    svd.save(folder)
    broken = SvdRecommender.load(spark, folder)
    broken.n_factors = 99
    # the second of three tables cannot be computed
    broken.item_factors = broken.item_factors.withColumn("product_id", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        broken.save(folder)
    loaded = SvdRecommender.load(spark, folder)
    assert loaded.n_factors == 4 and rows(loaded.recommend(users, 3)) == expected
    assert len(list_names(spark, f"{folder}/versions")) == 2
    assert versions.drop_old_versions(spark, folder) == 1


def test_nothing_saved(spark, folder):
    assert versions.load_version(spark, folder) is None
    with pytest.raises(FileNotFoundError, match="no model"):
        SvdRecommender.load(spark, folder)
    unfitted = HybridRecommender(SvdRecommender(), spark.createDataFrame(unit_vectors(2, 4, "p", 1)))
    with pytest.raises(RuntimeError, match="fit"):
        unfitted.save(folder)


def test_manifests_are_never_replaced(spark, folder):
    one = spark.range(3)
    for n in range(3):
        versions.save_version(spark, folder, {"t": one.limit(n)}, {"n": n})
    assert not create_file(spark, f"{folder}/manifests/000000000003.json", "{}")
    found = versions.load_version(spark, folder)
    assert (found.number, found.params, found.tables["t"].count()) == (3, {"n": 2}, 2)
    assert versions.drop_old_versions(spark, folder, keep=2) == 1
    assert list_names(spark, f"{folder}/manifests") == ["000000000002.json", "000000000003.json"]


def test_processed_tables_are_replaced_by_what_is_computed_from_them(spark, folder):
    def tables(n):
        return [spark.range(n).withColumnRenamed("id", c) for c in ("i", "p", "u")]

    sinks.save_processed(*tables(4), folder)
    found = readers.load_processed(spark, folder)
    sinks.save_processed(*(df.limit(2) for df in found), folder)
    assert [df.count() for df in readers.load_processed(spark, folder)] == [2, 2, 2]
    # tables that something else wrote
    for name, df in zip(readers.PROCESSED_TABLES, tables(5)):
        df.write.parquet(f"{folder}/plain/{name}.parquet")
    assert [df.count() for df in readers.load_processed(spark, f"{folder}/plain")] == [5, 5, 5]
