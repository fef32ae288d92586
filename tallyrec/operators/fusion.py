"""Fusion of collaborative and semantic candidates, and tuning of the fusion weight."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrec.functions.columns import round_half_up
from tallyrec.operators.metrics import CUT_OFF, fixed_mean, ideal_gain, relevant_products

# Default weight of the collaborative score, the constant of reciprocal rank fusion,
# candidates fetched per wanted result, digits of the fused scores.
ALPHA = 0.6
RANK_CONSTANT = 60
CANDIDATE_FACTOR = 3
WEIGHTED_DIGITS = 4
RANK_DIGITS = 6

# Weights tried by the tuning.
ALPHA_GRID = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8)


def weighted_fusion(
    cf: DataFrame,
    semantic: DataFrame,
    top_k: int | Column,
    alpha: float | Column = ALPHA,
    by: Sequence[str] = ("user_id",),
) -> DataFrame:
    """alpha * collaborative + (1 - alpha) * semantic; a missing score counts as 0.

    Both inputs are (*by, product_id, score, rank) with unique products per list. The result is
    (*by, product_id, score, rank).
    """
    weight = alpha if isinstance(alpha, Column) else F.lit(alpha)
    return _fuse(
        cf.withColumn("part", weight * F.col("score")),
        semantic.withColumn("part", (1 - weight) * F.col("score")),
        top_k,
        by,
        WEIGHTED_DIGITS,
    )


def rank_fusion(
    cf: DataFrame,
    semantic: DataFrame,
    top_k: int | Column,
    constant: int = RANK_CONSTANT,
    by: Sequence[str] = ("user_id",),
) -> DataFrame:
    """Reciprocal rank fusion: the sum of 1 / (constant + rank) over both lists."""
    part = 1 / (F.col("rank") + constant)
    return _fuse(
        cf.withColumn("part", part), semantic.withColumn("part", part), top_k, by, RANK_DIGITS
    )


def _fuse(
    cf: DataFrame, semantic: DataFrame, top_k: int | Column, by: Sequence[str], digits: int
) -> DataFrame:
    no_rank = F.lit(None).cast("int")
    both = cf.select(
        *by, "product_id", "part", F.col("rank").alias("cf_rank"), no_rank.alias("semantic_rank")
    ).unionByName(
        semantic.select(
            *by, "product_id", "part", no_rank.alias("cf_rank"), F.col("rank").alias("semantic_rank")
        )
    )
    # Grouping and ranking both work within a list, so one shuffle by list serves both.
    fused = (
        both.repartition(*by)
        .groupBy(*by, "product_id")
        .agg(
            F.sum("part").alias("score"),
            F.min("cf_rank").alias("cf_rank"),
            F.min("semantic_rank").alias("semantic_rank"),
        )
    )
    # equal scores: collaborative candidates first, each list in its own order
    order = Window.partitionBy(*by).orderBy(
        F.col("score").desc(), F.col("cf_rank").asc_nulls_last(), F.col("semantic_rank").asc()
    )
    return (
        fused.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top_k)
        .select(*by, "product_id", round_half_up(F.col("score"), digits).alias("score"), "rank")
    )


def tuning_users(ratings: DataFrame, limit: int | None = None) -> DataFrame:
    """The users that have a relevant product; with a ``limit``, the first ones in id order."""
    users = relevant_products(ratings).select("user_id").distinct()
    return users if limit is None else users.orderBy("user_id").limit(limit)


# What a candidate of a user's two lists is made of.
ENTRY = ("product_id", "cf_score", "cf_rank", "semantic_score", "semantic_rank")
_UNRANKED = 2**31 - 1


def gather_by_user(cf: DataFrame, semantic: DataFrame, *others: DataFrame) -> DataFrame:
    """One row per user with both lists put together: an array ``entries`` of ``ENTRY`` structs.

    ``cf`` and ``semantic`` are (user_id, product_id, score, rank). ``others`` are further rows about
    users or their products: (user_id, depth) gives the column ``depths``, the distinct depths of
    the user; (user_id, product_id, relevant) marks entries as ``relevant`` and counts the user's
    ``n_relevant`` products; (user_id, judge) sets ``judge``. All of it moves in one exchange.
    """
    kinds = {"depth": "int", "relevant": "boolean", "judge": "boolean"}
    rows = cf.select("user_id", "product_id", F.col("score").alias("cf_score"), F.col("rank").alias("cf_rank"))
    more = semantic.select(
        "user_id", "product_id", F.col("score").alias("semantic_score"), F.col("rank").alias("semantic_rank")
    )
    for df in (more, *others):
        rows = rows.unionByName(df, allowMissingColumns=True)
    for name, kind in kinds.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    figures = ("cf_score", "cf_rank", "semantic_score", "semantic_rank", "relevant", "judge")
    # a depth is a key of its own, so that only plain maxima are kept per product
    merged = (
        rows.repartition("user_id")
        .groupBy("user_id", "product_id", "depth")
        .agg(*(F.max(name).alias(name) for name in figures))
    )
    listed = F.col("cf_rank").isNotNull() | F.col("semantic_rank").isNotNull()
    entry = F.struct(*ENTRY, F.coalesce("relevant", F.lit(False)).alias("relevant"))
    return merged.groupBy("user_id").agg(
        F.collect_list(F.when(listed, entry)).alias("entries"),
        F.collect_list("depth").alias("depths"),
        F.count_if("relevant").alias("n_relevant"),
        F.coalesce(F.bool_or("judge"), F.lit(False)).alias("judge"),
    )


def fused_list(
    entries: Column, top_k: int | Column, depth: int | Column, alpha: float | Column | None
) -> Column:
    """The best ``top_k`` entries as an array of (loss, ..., product_id, relevant), best first.

    Of each list the first ``depth`` candidates count. The loss is the negative fused score: with
    ``alpha`` the weighted one, without it that of reciprocal rank fusion. Equal scores put
    collaborative candidates first, each list in its own order.
    """
    top_k, depth = (x if isinstance(x, Column) else F.lit(x) for x in (top_k, depth))

    def scored(entry: Column) -> Column:
        in_cf, in_semantic = entry["cf_rank"] <= depth, entry["semantic_rank"] <= depth
        if alpha is None:
            parts = [1 / (entry[r] + RANK_CONSTANT) for r in ("cf_rank", "semantic_rank")]
        else:
            weight = alpha if isinstance(alpha, Column) else F.lit(alpha)
            parts = [weight * entry["cf_score"], (1 - weight) * entry["semantic_score"]]
        cf, semantic = F.when(in_cf, parts[0]), F.when(in_semantic, parts[1])
        return F.struct(
            (-F.coalesce(cf + semantic, cf, semantic)).alias("loss"),
            F.coalesce(F.when(in_cf, entry["cf_rank"]), F.lit(_UNRANKED)).alias("cf_rank"),
            F.coalesce(F.when(in_semantic, entry["semantic_rank"]), F.lit(_UNRANKED)).alias("semantic_rank"),
            entry["product_id"].alias("product_id"),
            entry["relevant"].alias("relevant"),
        )

    inside = F.filter(entries, lambda e: (F.least(e["cf_rank"], e["semantic_rank"]) <= depth))
    return F.slice(F.array_sort(F.transform(inside, scored)), 1, top_k)


LISTS_SCHEMA = "user_id string, top_k int, products array<struct<product_id:string,score:double>>"


def fused_lists(gathered: DataFrame, alpha: float | None) -> DataFrame:
    """(user_id, top_k, products): the fused list of each of the ``depths`` of each user.

    ``gathered`` is the result of :func:`gather_by_user`; for a list of ``top_k`` products the first
    ``CANDIDATE_FACTOR * top_k`` of both lists count. Scores and order are those of
    :func:`weighted_fusion`, or without ``alpha`` those of :func:`rank_fusion`. Higher-order functions
    take some thirty times as long for lists of several hundred entries, so these are sorted as
    arrays, a batch of users at a time.
    """
    rows = gathered.select("user_id", "depths", *(F.col(f"entries.{name}").alias(name) for name in ENTRY))
    return rows.mapInArrow(_fuser(alpha), LISTS_SCHEMA)


def _fuser(alpha: float | None):
    factor, constant, unranked = CANDIDATE_FACTOR, RANK_CONSTANT, _UNRANKED
    scale = 10.0 ** (RANK_DIGITS if alpha is None else WEIGHTED_DIGITS)

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def flat(batch, name, missing):
        values = batch.column(name).flatten()
        if missing is None:
            return values.cast(pa.string())
        return pc.fill_null(values, missing).to_numpy(zero_copy_only=False)

    def fuse(batches):
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column("product_id")).to_numpy())
            ids = flat(batch, "product_id", None)
            scores = [flat(batch, name, 0.0) for name in ("cf_score", "semantic_score")]
            ranks = [flat(batch, name, unranked) for name in ("cf_rank", "semantic_rank")]
            users, depths, lengths, chosen, found = [], [], [], [], []
            for row, wanted in enumerate(batch.column("depths").to_pylist()):
                own = slice(ends[row - 1] if row else 0, ends[row])
                cf_rank, semantic_rank = ranks[0][own], ranks[1][own]
                for top_k in wanted:
                    cf_in, semantic_in = cf_rank <= factor * top_k, semantic_rank <= factor * top_k
                    if alpha is None:
                        cf, semantic = 1 / (cf_rank + constant), 1 / (semantic_rank + constant)
                    else:
                        cf, semantic = alpha * scores[0][own], (1 - alpha) * scores[1][own]
                    fused = np.where(cf_in, cf, 0.0) + np.where(semantic_in, semantic, 0.0)
                    inside = np.flatnonzero(cf_in | semantic_in)
                    # equal scores: collaborative candidates first, each list in its own order
                    later = np.where(semantic_in, semantic_rank, unranked)[inside]
                    first = np.where(cf_in, cf_rank, unranked)[inside]
                    best = inside[np.lexsort((later, first, -fused[inside]))[: max(top_k, 0)]]
                    users.append(row)
                    depths.append(top_k)
                    lengths.append(len(best))
                    chosen.append(best + own.start)
                    found.append(fused[best])
            positions = np.concatenate([np.zeros(0, np.int64), *chosen])
            rounded = np.floor(np.concatenate([np.zeros(0), *found]) * scale + 0.5) / scale
            offsets = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64))).astype(np.int32)
            products = pa.StructArray.from_arrays(
                [ids.take(pa.array(positions)), pa.array(rounded)], ["product_id", "score"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("user_id").take(pa.array(users, pa.int64())).cast(pa.string()),
                    pa.array(depths, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), products),
                ],
                ["user_id", "top_k", "products"],
            )

    return fuse


def alpha_scores(
    cf: DataFrame,
    semantic: DataFrame,
    relevant: DataFrame,
    users: DataFrame,
    alphas: Sequence[float] = ALPHA_GRID,
    k: int = CUT_OFF,
    weighted: bool = True,
) -> DataFrame:
    """(position, alpha, ndcg): mean NDCG@k per weight, in the order the weights were given.

    Each user's two lists meet once, with the user's relevant products; all weights are fused and
    judged inside that one row. The means do not depend on the order of the users, see
    :func:`tallyrec.operators.metrics.fixed_mean`.
    """
    wanted = relevant.select("user_id", "product_id").distinct().withColumn("relevant", F.lit(True))
    judges = users.select("user_id").distinct().withColumn("judge", F.lit(True))
    judged = gather_by_user(cf, semantic, wanted, judges).where("judge")
    gains = F.array(*(F.lit(1 / math.log2(i + 2)) for i in range(max(k, 1))))

    def ndcg(alpha: float) -> Column:
        best = fused_list(F.col("entries"), k, _UNRANKED - 1, alpha if weighted else None)
        hits = F.transform(best, lambda e, i: F.when(e["relevant"], F.get(gains, i)).otherwise(0.0))
        gain = F.aggregate(hits, F.lit(0.0), lambda total, hit: total + hit)
        ideal = ideal_gain(F.col("n_relevant"), k)
        return F.when(ideal > 0, gain / ideal).otherwise(0.0)

    weights = [
        F.struct(F.lit(i).alias("position"), F.lit(float(a)).alias("alpha"), ndcg(float(a)).alias("ndcg"))
        for i, a in enumerate(alphas)
    ]
    flat = judged.select(F.inline(F.array(*weights)))
    means = flat.groupBy("position", "alpha").agg(fixed_mean(F.col("ndcg")).alias("ndcg"))
    return means.orderBy("position")


def best_alpha(scores: DataFrame) -> DataFrame:
    """The weight with the highest mean NDCG; the first one wins a tie."""
    return scores.orderBy(F.col("ndcg").desc(), F.col("position").asc()).limit(1)
