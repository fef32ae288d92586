"""Recommendation models over tables: a truncated SVD, and its fusion with semantic search."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrec.functions.columns import unit_scale
from tallyrec.operators import factor
from tallyrec.operators.fusion import (
    ALPHA,
    ALPHA_GRID,
    CANDIDATE_FACTOR,
    alpha_scores,
    best_alpha,
    fused_lists,
    gather_by_user,
    tuning_users,
)
from tallyrec.operators.metrics import CUT_OFF, mean_metrics, relevant_products, user_metrics
from tallyrec.operators.nearest import top_matches
from tallyrec.operators.semantic import SemanticIndex, unique_vectors
from tallyrec.session import materialize
from tallyrec.sources.versions import Version, load_version, save_version

# Defaults of the models.
N_FACTORS = 50
RANDOM_STATE = 42
TOP_K = 10
VERSION = "1.0.0"

# A seed product is hot when it belongs to more than this share of the users, who are then spread
# over this many keys.
HOT_SHARE = 0.01
SEED_SALTS = 64


class Recommender(ABC):
    """What every model offers. Recommendations are (user_id, product_id, score, rank)."""

    _fitted = False

    @abstractmethod
    def fit(self, data: DataFrame) -> Recommender:
        """Train on (user_id, product_id, rating) and return self."""

    @abstractmethod
    def recommend(self, users: DataFrame, top_k: int | str = TOP_K) -> DataFrame:
        """The best products for every user; ``top_k`` is a number or a column of ``users``."""

    @abstractmethod
    def save(self, path: str) -> None:
        """Write the model as the newest version of a folder of Parquet tables.

        The folder may be the one it was loaded from. Earlier versions stay readable until
        :func:`tallyrec.sources.versions.drop_old_versions` deletes them.
        """

    @classmethod
    @abstractmethod
    def load(cls, spark: SparkSession, path: str) -> Recommender:
        """Read the newest model written by :meth:`save`."""

    def evaluate(self, test: DataFrame) -> DataFrame:
        """One row: precision_at_10, recall_at_10, ndcg_at_10, mrr.

        Means over the users with a relevant product in ``test``, known to the model or not.
        """
        self._check_fitted()
        relevant = relevant_products(test)
        found = self.recommend(relevant.select("user_id").distinct(), CUT_OFF)
        return mean_metrics(user_metrics(found, relevant, CUT_OFF))

    def _check_fitted(self) -> None:
        if not self._fitted:
            raise RuntimeError(f"{type(self).__name__} is not trained: call fit() first")


class SvdRecommender(Recommender):
    """Collaborative filtering by truncated SVD of the centred user x product matrix.

    Scores are scaled to [0, 1] per user over all products; products the user has already rated
    stay in. Unknown users get the most popular products with score 0. ``random_state`` is stored
    for completeness: the solver needs no seed.
    """

    def __init__(self, n_factors: int = N_FACTORS, random_state: int = RANDOM_STATE) -> None:
        self.n_factors = n_factors
        self.random_state = random_state

    def fit(self, data: DataFrame) -> SvdRecommender:
        cells = materialize(factor.rating_cells(data), "cells")
        size = cells.agg(
            F.count(F.lit(1)).alias("cells"), F.count_distinct("user_id").alias("users")
        ).first()
        items = materialize(factor.dense_index(cells, "product_id", "item_idx"), "items")
        n_items = items.count()
        rank = min(self.n_factors, size["users"] - 1, n_items - 1)
        if rank < 1:
            raise ValueError("the model needs at least two users and two products")
        factors = factor.factorize(cells, items, n_items, size["cells"], rank)
        self.user_factors = materialize(factors.users, "user-factors")
        self.item_factors = materialize(factors.items, "item-factors")
        self.popularity = materialize(popularity(cells), "popularity")
        self._fitted = True
        return self

    def recommend(self, users: DataFrame, top_k: int | str = TOP_K) -> DataFrame:
        self._check_fitted()
        wanted = users.groupBy("user_id").agg(F.max(_depth(top_k)).alias("depth"))
        known = wanted.join(self.user_factors, "user_id")
        queries = known.select(F.col("user_id").alias("query_id"), "vector", "depth")
        scored = scaled_scores(top_matches(queries, self.item_factors))
        unknown = wanted.join(self.user_factors, "user_id", "left_anti")
        deepest = top_k if isinstance(top_k, int) else wanted.agg(F.max("depth")).first()[0] or 0
        return scored.unionByName(popular_lists(self.popularity, unknown, deepest))

    TABLES = ("user_factors", "item_factors", "popularity")

    def save(self, path: str) -> None:
        self._check_fitted()
        save_version(self.user_factors.sparkSession, path, self._tables(), self._params())

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SvdRecommender:
        saved = _saved(spark, path)
        return cls._from(saved.tables, saved.params)

    def _tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.TABLES}

    def _params(self) -> dict:
        return {"n_factors": self.n_factors, "random_state": self.random_state}

    @classmethod
    def _from(cls, tables: dict[str, DataFrame], params: dict) -> SvdRecommender:
        model = cls(**params)
        for name in cls.TABLES:
            setattr(model, name, tables[name])
        model._fitted = True
        return model


def _depth(top_k: int | str) -> Column:
    # at least one result, as many as there are at most
    return F.greatest(F.col(top_k) if isinstance(top_k, str) else F.lit(top_k), F.lit(1)).cast("int")


def popularity(cells: DataFrame) -> DataFrame:
    """(product_id, n): rating rows per product."""
    return cells.groupBy("product_id").agg(F.sum("n").alias("n"))


def popular_items(counts: DataFrame, top_k: int) -> DataFrame:
    """The ``top_k`` most frequent products, ties by id."""
    return counts.orderBy(F.col("n").desc(), F.col("product_id").asc()).limit(top_k)


def popular_lists(counts: DataFrame, users: DataFrame, deepest: int) -> DataFrame:
    """The popular products, with score 0, for every row of (user_id, depth).

    No list is longer than ``deepest`` or the catalogue. Users meet the list by rank.
    """
    deepest = min(deepest, counts.count())
    order = Window.orderBy(F.col("n").desc(), F.col("product_id").asc())
    ranked = popular_items(counts, deepest).select("product_id", F.row_number().over(order).alias("rank"))
    ranks = F.sequence(F.lit(1), F.least("depth", F.lit(deepest)))
    ranks = F.when(F.lit(deepest) > 0, ranks).otherwise(F.array().cast("array<int>"))
    lists = users.select("user_id", F.explode(ranks).alias("rank"))
    return lists.join(ranked, "rank").select(
        "user_id", "product_id", F.lit(0.0).alias("score"), "rank"
    )


def scaled_scores(matches: DataFrame) -> DataFrame:
    """Matches as recommendations, each user's scores scaled over the whole catalogue."""
    return matches.select(
        F.col("query_id").alias("user_id"),
        "product_id",
        unit_scale(F.col("score"), F.col("low"), F.col("high")).alias("score"),
        "rank",
    )


class HybridRecommender(Recommender):
    """Fuses the collaborative list with products similar to its first entry.

    ``strategy`` is "weighted"; anything else means reciprocal rank fusion.
    """

    def __init__(
        self,
        cf: SvdRecommender,
        vectors: DataFrame,
        alpha: float = ALPHA,
        strategy: str = "weighted",
        version: str = VERSION,
    ) -> None:
        self.cf = cf
        self.vectors = vectors
        self.alpha = alpha
        self.strategy = strategy
        self.version = version
        self._fitted = cf._fitted
        self._index = SemanticIndex(vectors)

    @classmethod
    def build(
        cls, cf: SvdRecommender, vectors: DataFrame, order_by: Sequence, **settings
    ) -> HybridRecommender:
        """A model from vectors that may repeat a product: the first one by ``order_by`` counts."""
        first = unique_vectors(vectors, order_by).select("product_id", "embedding")
        return cls(cf, materialize(first, "vectors"), **settings)

    def fit(self, data: DataFrame) -> HybridRecommender:
        self.cf.fit(data)
        self._fitted = True
        return self

    def recommend(self, users: DataFrame, top_k: int | str = TOP_K) -> DataFrame:
        """As :meth:`Recommender.recommend`; with a column, each (user_id, column) is a list."""
        depth = F.lit(top_k) if isinstance(top_k, int) else F.col(top_k)
        lists = self.recommend_lists(users.select("user_id", depth.alias("top_k")))
        found = lists.select("user_id", "top_k", F.posexplode("products").alias("position", "found"))
        found = found.select(
            "user_id", "top_k", "found.product_id", "found.score", (F.col("position") + 1).alias("rank")
        )
        if isinstance(top_k, int):
            return found.drop("top_k")
        return found.withColumnRenamed("top_k", top_k)

    def recommend_lists(self, wanted: DataFrame) -> DataFrame:
        """(user_id, top_k, products) for every distinct (user_id, top_k): the list as one array of
        (product_id, score), best first.

        Candidates are exchanged once, by user, and all lists of a user come from the same row.
        """
        self._check_fitted()
        wanted = materialize(wanted.select("user_id", "top_k").distinct(), "wanted")
        cf, semantic = self.candidates(wanted)
        depths = wanted.select("user_id", F.col("top_k").cast("int").alias("depth"))
        gathered = gather_by_user(cf, semantic, depths)
        return fused_lists(gathered, self.alpha if self.strategy == "weighted" else None)

    def candidates(self, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Both candidate lists of each user in (user_id, top_k), 3 * top_k deep for the largest
        ``top_k`` of the user.

        The model is asked once per user and the index once per distinct seed, at the largest
        depth needed.
        """
        depth = F.max("top_k") * CANDIDATE_FACTOR
        users = wanted.groupBy("user_id").agg(depth.alias("depth"))
        cf = materialize(self.cf.recommend(users, "depth"), "cf-candidates")
        seeds = cf.where("rank = 1").select("user_id", F.col("product_id").alias("seed"))
        seeds = _join_user(seeds, users)
        asked = seeds.select(F.col("seed").alias("product_id"), "depth")
        similar = self._index.similar_lists(asked, "depth").withColumnRenamed("query_id", "seed")
        found = _join_by_seed(seeds, similar, hot_seeds(seeds))
        found = found.select("user_id", "depth", F.posexplode("matches").alias("position", "match"))
        semantic = found.where(F.col("position") < F.col("depth")).select(
            "user_id",
            "match.product_id",
            (-F.col("match.loss")).alias("score"),
            (F.col("position") + 1).alias("rank"),
        )
        return cf, semantic

    def tuning_scores(
        self,
        ratings: DataFrame,
        alphas: Sequence[float] = ALPHA_GRID,
        k: int = CUT_OFF,
        limit: int | None = None,
    ) -> DataFrame:
        """(position, alpha, ndcg) over the users of ``ratings`` that have a relevant product, or
        over the first ``limit`` of them."""
        self._check_fitted()
        users = tuning_users(ratings, limit)
        users = materialize(users, "judges")
        cf, semantic = self.candidates(users.withColumn("top_k", F.lit(k)))
        return alpha_scores(
            cf, semantic, relevant_products(ratings), users, alphas, k, self.strategy == "weighted"
        )

    def tune_alpha(
        self,
        ratings: DataFrame,
        alphas: Sequence[float] = ALPHA_GRID,
        k: int = CUT_OFF,
        limit: int | None = None,
    ) -> float:
        """Set and return the weight with the best mean NDCG@k; keep it when nobody can judge."""
        best = best_alpha(self.tuning_scores(ratings, alphas, k, limit)).first()
        if best is not None:
            self.alpha = best["alpha"]
        return self.alpha

    def save(self, path: str) -> None:
        self._check_fitted()
        params = {"alpha": self.alpha, "strategy": self.strategy, "version": self.version}
        save_version(
            self.vectors.sparkSession,
            path,
            {**self.cf._tables(), "vectors": self.vectors},
            {"model": params, "cf": self.cf._params()},
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HybridRecommender:
        saved = _saved(spark, path)
        cf = SvdRecommender._from(saved.tables, saved.params["cf"])
        return cls(cf, saved.tables["vectors"], **saved.params["model"])


def _join_user(left: DataFrame, right: DataFrame) -> DataFrame:
    """An inner join by ``user_id`` in which a missing id is an id like any other."""
    right = right.withColumnRenamed("user_id", "_user")
    return left.join(right, left["user_id"].eqNullSafe(right["_user"])).drop("_user")


def hot_seeds(seeds: DataFrame) -> DataFrame:
    """The seeds that belong to more than ``HOT_SHARE`` of the users: at most 1 / HOT_SHARE."""
    users = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
    return users.where(F.col("n") > users.agg(F.sum("n")).scalar() * HOT_SHARE).select("seed")


def _join_by_seed(lists: DataFrame, similar: DataFrame, hot: DataFrame) -> DataFrame:
    """``lists`` with the list of its seed, from (user_id, ..., seed) and (seed, matches).

    One seed may belong to most users - all unknown users share theirs. The lists of hot seeds are
    spread over ``SEED_SALTS`` keys and the seeds' lists repeated for all of them.
    """
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("user_id"), F.lit(SEED_SALTS)).cast("int"))
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SEED_SALTS - 1)))
    left = lists.join(hot, "seed", "left").withColumn("_salt", F.coalesce(salt, F.lit(0)))
    right = similar.join(hot, "seed", "left").withColumn(
        "_salt", F.explode(F.coalesce(salts, F.array(F.lit(0))))
    )
    return left.drop("_hot").join(right.drop("_hot"), ["seed", "_salt"]).drop("seed", "_salt")


def _saved(spark: SparkSession, path: str) -> Version:
    saved = load_version(spark, path)
    if saved is None:
        raise FileNotFoundError(f"no model is saved in {path}")
    return saved
