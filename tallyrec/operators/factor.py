"""Pieces of the factor model: dense indexes, the centred rating matrix, its truncated SVD."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.mllib.linalg import VectorUDT
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrec.operators import lanczos
from tallyrec.session import materialize

# the workers need no copy of this package
cloudpickle.register_pickle_by_value(lanczos)

# Ids are numbered within this many buckets at a time: the first hex digits of their md5 hash.
INDEX_DIGITS = 3

# Singular values below this share of the largest are noise: the solver works on the square of
# the matrix, which halves the digits.
NOISE_SHARE = 1e-6

# Matrix cells per task of a solver step. A step is short, so small matrices want few tasks; past
# the second bound, tasks multiply instead of growing.
MIN_CELLS_PER_TASK = 1 << 20
MAX_CELLS_PER_TASK = 1 << 24

# MLlib's solver runs a job for each of its hundreds of steps, and keeps the item side on the driver. It
# takes matrices of so many cells at most. This is the memory it may take on the driver: per entry of
# the n_items x k factors it needs the result, a work space of twice that size, and copies on the way to
# Python. All other matrices are solved inside one task, see lanczos.
SOLVER_CELLS = 1 << 18
SOLVER_BYTES = 2 << 30
SOLVER_BYTES_PER_ENTRY = 48

# Factors that a task gives out at a time.
ROWS_OUT = 4096

# Cells whose products with the factors are held at a time by a task.
CELLS_PER_STEP = 1 << 16


def dense_index(ids: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name): distinct ids numbered from 0 without gaps, ordered by (hash bucket, id).

    Each bucket is numbered by its own task; only the bucket sizes are summed up together.
    """
    distinct = ids.select(key).where(F.col(key).isNotNull()).distinct()
    bucketed = distinct.withColumn("_bucket", F.substring(F.md5(F.col(key)), 1, INDEX_DIGITS))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    return (
        bucketed.withColumn("_position", position)
        .join(F.broadcast(offsets), "_bucket")
        .select(key, (F.col("_offset") + F.col("_position")).alias(name))
    )


def rating_cells(ratings: DataFrame) -> DataFrame:
    """(user_id, product_id, value, n): ratings of a repeated pair are summed, n counts them."""
    return (
        ratings.select(
            F.col("user_id").cast("string"),
            F.col("product_id").cast("string"),
            F.col("rating").cast("double"),
        )
        .na.drop()
        .groupBy("user_id", "product_id")
        .agg(F.sum("rating").alias("value"), F.count(F.lit(1)).alias("n"))
    )


def user_offsets(cells: DataFrame, n_items: int) -> DataFrame:
    """(user_id, offset): the user's sum over the number of all items, rated or not."""
    return cells.groupBy("user_id").agg((F.sum("value") / n_items).alias("offset"))


def centred_cells(cells: DataFrame, n_items: int) -> DataFrame:
    """``cells`` with the user's offset subtracted from the stored cells; empty cells stay 0."""
    return cells.join(user_offsets(cells, n_items), "user_id").withColumn(
        "centred", F.col("value") - F.col("offset")
    )


def centred_rows(cells: DataFrame, items: DataFrame, n_items: int) -> DataFrame:
    """(user_id, offset, indices, values): one sparse row per user, at most ``n_items`` long."""
    entry = F.struct(F.col("item_idx").cast("int").alias("index"), "value")
    rows = (
        cells.join(items, "product_id")
        .groupBy("user_id")
        .agg(
            F.sort_array(F.collect_list(entry)).alias("entries"),
            (F.sum("value") / n_items).alias("offset"),
        )
    )
    return rows.select(
        "user_id",
        "offset",
        F.col("entries.index").alias("indices"),
        F.transform("entries.value", lambda value: value - F.col("offset")).alias("values"),
    )


class Factors(NamedTuple):
    """User factors A*V and item factors V, as (id, ..., vector) tables."""

    users: DataFrame
    items: DataFrame


def check_solver_budget(n_items: int, k: int, budget: int = SOLVER_BYTES) -> None:
    """Fail if the item side of MLlib's solver would not fit the driver's ``budget`` of bytes."""
    needed = n_items * k * SOLVER_BYTES_PER_ENTRY
    if needed > budget:
        raise ValueError(
            f"{n_items} products with {k} factors need about {needed >> 20} MB of driver memory, "
            f"the budget is {budget >> 20} MB: raise it, use fewer factors or fewer products"
        )


def factorize(cells: DataFrame, items: DataFrame, n_items: int, n_cells: int, k: int) -> Factors:
    """Truncated SVD of the centred matrix: at most ``k`` factors.

    MLlib solves small matrices, a single task the others. Neither holds the item side on the driver
    unless it is small.
    """
    rows = materialize(centred_rows(cells, items, n_items), "rows")
    if n_cells > SOLVER_CELLS or n_items * k * SOLVER_BYTES_PER_ENTRY > SOLVER_BYTES:
        return _factors_of_task(rows, items, n_items, n_cells, k)
    basis = _right_basis(rows, n_items, n_cells, k)
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(basis)
    cells_per_step = CELLS_PER_STEP

    def project(batches):
        v = shared.value
        for batch in batches:
            starts = batch.column("indices").offsets.to_numpy().astype(np.int64)
            indices = batch.column("indices").values.to_numpy(zero_copy_only=False)
            values = batch.column("values").values.to_numpy(zero_copy_only=False)
            vectors = np.zeros((batch.num_rows, v.shape[1]))
            row = 0
            while row < batch.num_rows:
                # as many whole users as there are cells in a step, one at least
                end = int(np.searchsorted(starts, starts[row] + cells_per_step, side="right")) - 1
                end = min(max(end, row + 1), batch.num_rows)
                low, high = starts[row], starts[end]
                products = values[low:high, None] * v[indices[low:high]]
                some = row + np.flatnonzero(np.diff(starts[row : end + 1]))
                if len(some):
                    vectors[some] = np.add.reduceat(products, starts[some] - low, axis=0)
                row = end
            nested = pa.FixedSizeListArray.from_arrays(pa.array(vectors.ravel()), v.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("user_id"), batch.column("offset"), nested.cast(pa.list_(pa.float64()))],
                names=["user_id", "offset", "vector"],
            )

    user_factors = rows.mapInArrow(project, "user_id string, offset double, vector array<double>")
    vectors = pa.FixedSizeListArray.from_arrays(pa.array(basis.ravel()), basis.shape[1])
    numbered = spark.createDataFrame(
        pa.table({"item_idx": np.arange(n_items), "vector": vectors.cast(pa.list_(pa.float64()))})
    )
    item_factors = items.join(numbered, "item_idx").select("product_id", "vector")
    return Factors(user_factors, item_factors)


def _factors_of_task(rows: DataFrame, items: DataFrame, n_items: int, n_cells: int, k: int) -> Factors:
    """The factors by :mod:`tallyrec.operators.lanczos` in one task, which also gives out both tables."""
    noise_share, rows_out = NOISE_SHARE, ROWS_OUT
    kind = "user_id string, offset double, item_idx long, vector array<double>"

    def given_out(users, offsets, numbers, vectors):
        nested = pa.FixedSizeListArray.from_arrays(pa.array(vectors.ravel()), vectors.shape[1])
        arrays = [users, offsets, numbers, nested.cast(pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(arrays, names=["user_id", "offset", "item_idx", "vector"])

    def solve(batches):
        ids, offsets, lengths, at = [], [], [], 0
        columns, values = lanczos.new_array((n_cells,), np.int32), lanczos.new_array((n_cells,), float)
        for batch in batches:
            ids.append(batch.column("user_id").cast(pa.string()))
            offsets.append(batch.column("offset"))
            lengths.append(np.diff(batch.column("indices").offsets.to_numpy()))
            flat = batch.column("indices").flatten().to_numpy(zero_copy_only=False)
            part = slice(at, at + len(flat))
            columns[part] = flat
            values[part] = batch.column("values").flatten().to_numpy(zero_copy_only=False)
            at += len(flat)
        if not at:
            return
        ids, offsets = pa.concat_arrays(ids), pa.concat_arrays(offsets)
        matrix = lanczos.SparseMatrix(np.concatenate(lengths), columns[:at], values[:at], n_items)
        found, basis = lanczos.leading_vectors(matrix.gram_times, n_items, k)
        sizes = np.sqrt(np.maximum(found, 0))
        kept = max(1, int((sizes >= noise_share * sizes[0]).sum()))
        by_item = lanczos.new_array((n_items, kept), float)
        for start in range(0, n_items, rows_out):
            part = slice(start, start + rows_out)
            by_item[part] = basis[:kept, part].T
            n = len(by_item[part])
            none = pa.nulls(n, pa.string()), pa.nulls(n, pa.float64())
            yield given_out(*none, pa.array(np.arange(start, start + n)), by_item[part])
        for start in range(0, len(ids), rows_out):
            vectors = matrix.times(by_item, slice(start, start + rows_out))
            n = len(vectors)
            yield given_out(ids.slice(start, n), offsets.slice(start, n), pa.nulls(n, pa.int64()), vectors)

    found = materialize(rows.coalesce(1).mapInArrow(solve, kind), "factors")
    users = found.where("item_idx is null").select("user_id", "offset", "vector")
    numbered = found.where("item_idx is not null").select("item_idx", "vector")
    return Factors(users, items.join(numbered, "item_idx").select("product_id", "vector"))


def sparse_vectors(rows: DataFrame, size: int) -> DataFrame:
    """``row``: the (indices, values) of each row as a sparse vector.

    A vector is stored as a struct of its kind, size, indices and values. The struct is written and
    read back under the vector's type, so rows never pass through Python.
    """
    row = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), "indices", "values"
    )
    schema = T.StructType([T.StructField("row", VectorUDT())])
    return materialize(rows.select(row.alias("row")), "vectors", schema)


def _right_basis(rows: DataFrame, n_items: int, n_cells: int, k: int) -> np.ndarray:
    """The k leading right singular vectors as an (n_items, k) array."""
    check_solver_budget(n_items, k, SOLVER_BYTES)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = math.ceil(n_cells / MIN_CELLS_PER_TASK)
    tasks = max(1, min(tasks, max(cores, math.ceil(n_cells / MAX_CELLS_PER_TASK))))
    # the solver passes over the rows hundreds of times
    vectors = sparse_vectors(rows, n_items).repartition(tasks)
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        matrix = RowMatrix(vectors, numCols=n_items)
        return matrix.computeSVD(k, computeU=False, rCond=NOISE_SHARE).V.toArray()
    finally:
        vectors.unpersist()
