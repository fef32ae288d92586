"""Exact top-k by inner product in tiles.

Queries are cut into blocks and all rows into shards. A tile is one block against one shard: a
matrix product of which only each query's best rows leave the task. The lists of a query are then
merged as a tree, ``FAN_IN`` shards at a time, so no group ever holds more than ``FAN_IN * k`` rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrec.llm.vectors import as_doubles, is_finite, matrix
from tallyrec.session import materialize

QUERY_ROWS = 16384
SHARD_ROWS = 4096
FAN_IN = 16
K = 20
SCALE = 64
_PRODUCT_ROWS = 512  # queries per matrix product inside a tile
_EXACT = 2.0**52  # whole doubles up to here add without rounding


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component; what does not fit a long is held at its limit."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x))


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as int64, held at the limits of a long."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    most = float(np.abs(queries.astype(float)).max()) * float(np.abs(rows.astype(float)).max())
    if most * queries.shape[1] < _EXACT:
        return (queries.astype(float) @ rows.T.astype(float)).astype(np.int64)
    limits = np.iinfo(np.int64)
    exact = queries.astype(object) @ rows.T.astype(object)
    return np.clip(exact, limits.min, limits.max).astype(np.int64)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Column numbers of the ``k`` highest scores per row, lower columns first among equals."""
    n = scores.shape[1]
    k = min(k, n)
    if np.abs(scores.astype(float)).max(initial=0) < 2.0**62 / max(n, 1):
        unique = scores * n + np.arange(n - 1, -1, -1)
        best = np.broadcast_to(np.arange(n), scores.shape)
        if k < n:
            best = np.argpartition(unique, n - k, axis=1)[:, n - k :]
        order = np.argsort(-np.take_along_axis(unique, best, axis=1), axis=1)
        return np.take_along_axis(best, order, axis=1)
    rows = [sorted(range(n), key=lambda j, row=row: (-int(row[j]), j))[:k] for row in scores]
    return np.array(rows, np.int64).reshape(len(scores), k)


_TILE_SCHEMA = "query_id long, query_key long, shard int, vec_id long, score long"


def _tile(k: int) -> Callable:
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        kinds = [("query_id", pa.int64()), ("query_key", pa.int64()), ("shard", pa.int32())]
        schema = pa.schema([*kinds, ("vec_id", pa.int64()), ("score", pa.int64())])
        if not len(queries) or not len(rows):
            return schema.empty_table()
        dim, shard = rows["dim"][0].as_py(), rows["shard"][0].as_py()
        rows = rows.take(pc.sort_indices(rows, [("vec_id", "ascending")]))  # null ids last
        ids = rows["vec_id"].combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        numbers = ids.fill_null(0).to_numpy()
        repeats = int(np.unique(numbers, return_counts=True)[1].max())
        right = matrix(rows["vector"], dim)
        tables = []
        for at in range(0, len(queries), _PRODUCT_ROWS):
            some = queries.slice(at, _PRODUCT_ROWS)
            asked, keys = some["query_id"].to_numpy(), some["query_key"].to_numpy()
            scores = _scores(matrix(some["vector"], dim), right)
            best = _best(scores, k + repeats)
            other = (numbers[best] != asked[:, None]) | ~known[best]
            chosen = other & (np.cumsum(other, axis=1) <= k)
            row, column = np.nonzero(chosen)[0], best[chosen]
            arrays = [
                pa.array(asked[row]),
                pa.array(keys[row]),
                pa.array(np.full(len(row), shard, np.int32)),
                ids.take(pa.array(column)),
                pa.array(scores[row, column]),
            ]
            tables.append(pa.table(arrays, schema=schema))
        return pa.concat_tables(tables)

    return run


def top_products(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    query_rows: int = QUERY_ROWS,
    shard_rows: int = SHARD_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest inner products for each row of ``queries``.

    Both tables have ``vec_id`` and ``embedding``; components become ``floor(64 * x)``. Returns
    ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``; ties go to the smaller ``vec_id``,
    a null one last. Rows with the query's ``vec_id`` are not its candidates. All candidates are
    returned where there are fewer than ``k``. Vectors that are null or hold null or non-finite
    components take no part, and vectors of different lengths are not compared. Repeated candidate
    rows all count; equal queries are answered once, and an id that comes with two vectors is two
    queries. Other columns are ignored; empty tables give an empty result.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    rows = materialize(_usable(vectors), "search-rows")
    asked = _usable(queries).where(F.col("vec_id").isNotNull()).distinct()
    asked = asked.withColumn("query_key", F.xxhash64("vector"))
    asked = materialize(asked.withColumnRenamed("vec_id", "query_id"), "search-queries")
    n_blocks = max(1, -(-asked.count() // query_rows))
    n_shards = max(1, -(-rows.count() // shard_rows))

    dealt = F.pmod(F.xxhash64("query_id", "query_key"), F.lit(n_blocks)).cast("int")
    tiles = asked.withColumn("block", dealt).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))
    )
    # the row number deals equal ids and equal vectors apart, too
    number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_shards)).cast("int")
    shards = rows.withColumn("shard", number).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    )
    key = ("dim", "shard", "block")
    lists = (
        tiles.groupBy(*key).cogroup(shards.groupBy(*key)).applyInArrow(_tile(k), _TILE_SCHEMA)
    )
    order = [F.desc("score"), F.asc_nulls_last("vec_id")]
    while True:
        n_shards = -(-n_shards // fan_in)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / fan_in).cast("int"))
        own = Window.partitionBy("query_id", "query_key", "shard").orderBy(*order)
        lists = lists.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
        if n_shards == 1:
            return lists.select("query_id", "rank", "vec_id", "score")


def _usable(vectors: DataFrame) -> DataFrame:
    slim = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), as_doubles("embedding").alias("vector")
    )
    return slim.where(is_finite(F.col("vector"))).select(
        "vec_id", F.size("vector").alias("dim"), quantized(F.col("vector")).alias("vector")
    )
