import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows, unit_vectors
from pyspark.sql import functions as F

from tallyrec.operators import nearest, semantic
from tallyrec.operators.nearest import top_matches


def arrays(df):
    data = df.orderBy("product_id").collect()
    return [r["product_id"] for r in data], np.array([r["embedding"] for r in data], dtype=float)


def brute_force(query, ids, matrix, k, leave_out=None):
    scores = np.floor(matrix @ query * 1e9 + 0.5) / 1e9
    found = [(-s, i) for s, i in zip(scores, ids) if i != leave_out]
    return [(i, -s) for s, i in sorted(found)[:k]]


def lists(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["product_id"], pytest.approx(r["score"], abs=2e-9)))
    return out


@pytest.mark.parametrize("k", [1, 5, 100])
def test_similar_products(spark, vectors, k):
    ids, matrix = arrays(vectors)
    wanted = spark.createDataFrame([("p3",), ("p7",), ("p7",), ("nowhere",)], "product_id string")
    found = lists(semantic.SemanticIndex(vectors).similar_products(wanted, k))
    assert found == {
        p: brute_force(matrix[ids.index(p)], ids, matrix, k, p) for p in ("p3", "p7")
    }
    assert all(len(found[p]) == min(k, 19) for p in found)


@pytest.mark.parametrize("k", [1, 7, 50])
def test_similar_to_vector(spark, vectors, k):
    ids, matrix = arrays(vectors)
    queries = spark.createDataFrame(unit_vectors(9, 16, "q", 0)).withColumnRenamed("product_id", "query_id")
    found = lists(semantic.SemanticIndex(vectors).similar_to_vector(queries, k))
    for row in queries.collect():
        assert found[row["query_id"]] == brute_force(np.array(row["embedding"], float), ids, matrix, k)


@pytest.mark.parametrize("exclude", [True, False])
@pytest.mark.parametrize("block_bytes", [600, 2000, 100_000])
def test_blocks_of_any_size_agree(spark, vectors, exclude, block_bytes):
    # equal vectors under many ids: every score is a tie
    copies = vectors.select(F.concat("product_id", F.lit("-copy")).alias("product_id"), "embedding")
    index = vectors.union(copies).withColumnRenamed("embedding", "vector")
    queries = index.select(
        F.col("product_id").alias("query_id"), "vector", (F.length("product_id") - 1).alias("depth")
    )
    whole = top_matches(queries, index, exclude)
    assert rows(whole) == rows(top_matches(queries, index, exclude, block_bytes=block_bytes))
    depth = {r["query_id"]: r["depth"] for r in queries.collect()}
    counts = {r["query_id"]: r["count"] for r in whole.groupBy("query_id").count().collect()}
    assert counts == depth


def test_small_blocks_of_a_large_table_grow():
    small, default, many = 16 << 10, nearest.BLOCK_BYTES, nearest.MOST_COPIES
    assert nearest._block_bytes([many * small, 10], small) == small
    assert nearest._block_bytes([10, 52 << 20], small) == -(-(52 << 20) // many)
    assert nearest._block_bytes([10 << 30], small) == default
    assert nearest._block_bytes([10 << 30], 3 * default) == 3 * default
    assert nearest._block_bytes([], small) == small


def test_tables_are_copied_a_few_times_only(spark, monkeypatch):
    index = spark.createDataFrame(unit_vectors(400, 16, "p", 3)).withColumnRenamed("embedding", "vector")
    queries = index.select(F.col("product_id").alias("query_id"), "vector", F.lit(4).alias("depth"))
    whole, copies, every = rows(top_matches(queries, index, True)), [], nearest._every
    monkeypatch.setattr(nearest, "_every", lambda n, name: copies.append(n) or every(n, name))
    assert rows(top_matches(queries, index, True, block_bytes=1 << 10)) == whole  # 50 such blocks
    assert copies == [8, 8]


def test_repeated_ids_in_grown_blocks_match_as_in_small_ones(spark, monkeypatch):
    index = spark.createDataFrame(unit_vectors(150, 16, "p", 3)).withColumnRenamed("embedding", "vector")
    index = index.union(index).union(index.where("product_id < 'p3'"))
    queries = index.distinct().select(F.col("product_id").alias("query_id"), "vector", F.lit(3).alias("depth"))
    grown = rows(top_matches(queries, index, True, 1 << 10))
    monkeypatch.setattr(nearest, "_block_bytes", lambda tables, wanted: wanted)
    assert grown == rows(top_matches(queries, index, True, 1 << 10))


@pytest.mark.parametrize("k", [1, 3, 40])
def test_best_of_many_scores(spark, k):
    # scores that differ from the tenth digit on are ties; the better half of them are in one group
    rng = np.random.default_rng(6)
    score = np.repeat(rng.random(250), 4) + np.tile([0.0, 3e-11, -3e-11, 1e-12], 250)
    score[::64] += 2
    ids = [f"p{i:04}" for i in range(1000)]
    index = spark.createDataFrame(pa.table({"product_id": ids, "vector": [[x, 1.0] for x in score]}))
    queries = [("q", [1.0, 0.0], k), ("r", [-1.0, 0.5], 2), ("p0064", [1.0, 0.0], k), ("inf", [float("inf"), 0.0], 2)]
    queries = spark.createDataFrame(queries, "query_id string, vector array<double>, depth int")
    found = lists(top_matches(queries.where("query_id <> 'inf'"), index, True))
    matrix = np.stack([score, np.ones(1000)], axis=1)
    for query, vector, depth, own in (("q", [1, 0], k, None), ("r", [-1, 0.5], 2, None), ("p0064", [1, 0], k, "p0064")):
        assert found[query] == brute_force(np.array(vector, float), ids, matrix, depth, own)
    assert "inf" not in lists(top_matches(queries, index, True))


def test_more_ties_than_results(spark):
    index = spark.createDataFrame([(f"p{i:02}", [1.0, 0.0]) for i in range(30)], "product_id string, vector array<double>")
    queries = spark.createDataFrame([("q", [1.0, 0.0], 4)], "query_id string, vector array<double>, depth int")
    found = top_matches(queries, index).orderBy("rank")
    assert [r["product_id"] for r in found.collect()] == ["p00", "p01", "p02", "p03"]


@pytest.mark.parametrize("block_bytes", [600, 100_000])
@pytest.mark.parametrize("k", [1, 2, 5, 50])
def test_null_zero_and_nan_vectors(spark, vectors, k, block_bytes):
    odd = [("null", None), ("hole", [None] + [0.1] * 15), ("nan", [float("nan")] * 16), ("zero", [0.0] * 16)]
    extra = spark.createDataFrame(odd, "product_id string, embedding array<float>")
    index = vectors.union(extra).withColumnRenamed("embedding", "vector")
    queries = index.select(F.col("product_id").alias("query_id"), "vector", F.lit(k).alias("depth"))
    found = top_matches(queries, index, True, block_bytes)
    counts = {r["query_id"]: r["count"] for r in found.groupBy("query_id").count().collect()}
    assert counts == {**{f"p{i}": min(k, 20) for i in range(20)}, "zero": min(k, 20)}
    assert {r["product_id"] for r in found.collect()}.isdisjoint({"null", "hole", "nan"})


def test_vectors_of_different_lengths_are_an_error(spark):
    index = spark.createDataFrame([("a", [1.0]), ("b", [1.0, 2.0])], "product_id string, vector array<double>")
    queries = spark.createDataFrame([("q", [1.0, 0.0], 4)], "query_id string, vector array<double>, depth int")
    with pytest.raises(ValueError, match="between 1 and 2"):
        top_matches(queries, index)
    with pytest.raises(Exception, match="a query has 2 elements, the index 1"):
        top_matches(queries, index.where("product_id = 'a'")).count()


def test_empty_index(spark, vectors):
    index = semantic.SemanticIndex(vectors.where("false"))
    assert index.similar_products(vectors.select("product_id"), 3).count() == 0


def test_first_vector_of_a_product_counts(spark):
    vectors = spark.createDataFrame(
        [("p", [1.0, 0.0], 2), ("p", [0.0, 1.0], 1)], "product_id string, embedding array<double>, n int"
    )
    assert rows(semantic.unique_vectors(vectors, ["n"]), "embedding") == [([0.0, 1.0],)]


def test_product_texts(spark):
    products = spark.createDataFrame(
        [("1", "A", "a"), ("2", "B", None), ("3", None, "c"), ("4", None, None), ("5", "", "e")],
        "product_id string, title string, description string",
    )
    assert rows(semantic.product_texts(products), "text") == sorted(
        [("A | a",), ("B",), ("c",), ("4",), (" | e",)]
    )
    assert rows(semantic.product_texts(products.select("product_id")), "text") == [
        ("1",), ("2",), ("3",), ("4",), ("5",),
    ]


def test_hashed_words(spark):
    products = spark.createDataFrame(
        [("1", "red lamp", None), ("2", "lamp RED", None), ("3", "blue desk", None)],
        "product_id string, title string, description string",
    )
    embedded = semantic.embed_products(products)
    assert dict(embedded.dtypes)["embedding"] == "array<float>"
    ids, matrix = arrays(embedded)
    assert matrix.shape == (3, 384)
    assert np.linalg.norm(matrix, axis=1) == pytest.approx([1, 1, 1], abs=1e-6)
    assert matrix[0] @ matrix[1] == pytest.approx(1, abs=1e-6)


def test_own_encoder_gets_batches_and_is_normalized(spark):
    def load_encoder():
        return lambda texts: [[float(len(texts)), float(len(text))] for text in texts]

    texts = spark.range(10).coalesce(1).select(F.col("id").alias("product_id"), F.lit("abc").alias("text"))
    embedded = semantic.embed_texts(texts, load_encoder, batch_size=4)
    _, matrix = arrays(embedded)
    assert np.linalg.norm(matrix, axis=1) == pytest.approx(np.ones(10), abs=1e-6)
    # batches of 4, 4 and 2
    ratios = np.round(matrix[:, 0] / matrix[:, 1] * 3).astype(int)
    assert sorted(ratios) == [2] * 2 + [4] * 8


def test_one_plan_for_any_number_of_blocks(spark, vectors, monkeypatch):
    """The index never passes through the driver, and blocks change numbers in the plan only."""
    index = vectors.withColumnRenamed("embedding", "vector")
    queries = index.select(F.col("product_id").alias("query_id"), "vector", F.lit(3).alias("depth"))
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.toArrow", None)
    monkeypatch.setattr("pyspark.SparkContext.broadcast", None)
    nodes, found = set(), set()
    for block_bytes in (1 << 20, 128 * 7, 128):  # 1, 3 and 20 blocks
        df = top_matches(queries, index, True, block_bytes)
        plan = df._jdf.queryExecution().executedPlan().toString()
        nodes.add(tuple(re.findall(r"[+:]- (?:\*\(\d+\) )?(\w+)", plan)))
        found.add(tuple(rows(df)))
    assert len(nodes) == 1 and len(found) == 1
    (names,) = nodes
    assert names.count("FlatMapCoGroupsInArrow") == 1 and "Union" not in names and "BroadcastExchange" not in names
