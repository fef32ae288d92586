"""Exact top-k inner products between a table of query vectors and a table of product vectors.

No pair of rows is ever joined or emitted. Both tables are packed into chunks of some hundred vectors
a row and dealt into blocks; a task multiplies one block of queries with one block of the index, and
only the best matches of each query leave it. The lists of a query are then merged in two steps, so
that no step holds more than the square root of the number of index blocks of them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrec.session import materialize

# Size of the vectors in a block of either table; a task holds one of each.
BLOCK_BYTES = 32 << 20

# Smaller blocks grow, to BLOCK_BYTES at most, where a table would have more of them than this: the
# other table is copied once for each.
MOST_COPIES = 8

# Vectors packed into a row, unless a block is smaller than a few such rows, and the fewest query
# vectors of a block that is made smaller so that all cores have something to do.
CHUNK_ROWS = 512
LEAST_QUERIES = 256

# Scores held in memory at a time, as a number of matrix cells.
CELLS_PER_STEP = 1 << 23

# Scores of a query that are first cut to their largest, where there are many times as many as wanted.
GROUP_SCORES = 64

# Scores are compared after rounding to this many digits. The last bits of a matrix product depend
# on how its rows are batched; without rounding, so would the order of equal scores.
SCORE_DIGITS = 9

PACKED_SCHEMA = "side int, n int, width int, ids array<string>, depths array<int>, vectors binary"
TILE_SCHEMA = (
    "query_id string, branch int, depth int, low double, high double, "
    "matches array<struct<loss:double,product_id:string>>"
)


def match_lists(
    queries: DataFrame,
    index: DataFrame,
    exclude_self: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(query_id, low, high, matches): the ``depth`` best products of every query as one array.

    ``queries`` is (query_id, vector, depth) and ``index`` (product_id, vector), both with unique
    ids. ``exclude_self`` leaves out the product whose id equals the query id. ``matches`` holds
    (loss, product_id), best first: the loss is the negative inner product, ties go by product id.
    ``low`` and ``high`` are the smallest and largest score of the query over the whole index.
    Vectors that are null or hold a null or NaN take no part; vectors of different lengths are an
    error.

    Blocks hold at most about ``block_bytes`` of vectors, or ``BLOCK_BYTES`` if that is more and a
    table is larger than ``MOST_COPIES`` such blocks. The plan is the same for any number of blocks,
    and neither table passes through the driver.
    """
    queries = _usable(queries, "query_id", F.col("depth").cast("int").alias("depth"))
    index = _usable(index, "product_id", F.lit(None).cast("int").alias("depth"))
    both = (
        df.withColumnRenamed(key, "id").mapInArrow(_packer(side, block_bytes), PACKED_SCHEMA)
        for side, (df, key) in enumerate(((queries, "query_id"), (index, "product_id")))
    )
    packed = materialize(reduce(DataFrame.union, both), "packed")
    sizes = packed.groupBy("side").agg(
        F.sum("n").alias("n"), F.min("width").alias("least"), F.max("width").alias("width")
    )
    sizes = {row["side"]: row for row in sizes.collect()}
    n_queries, n_index, cores = 1, 1, packed.sparkSession.sparkContext.defaultParallelism
    n_parts, wanted_bytes = 1, block_bytes
    block_bytes = _block_bytes([row["n"] * row["width"] * 8 for row in sizes.values()], block_bytes)
    if 1 in sizes:
        if sizes[1]["least"] != sizes[1]["width"]:
            raise ValueError(
                "the vectors of the index have between "
                f"{sizes[1]['least']} and {sizes[1]['width']} elements"
            )
        index_bytes = sizes[1]["n"] * sizes[1]["width"] * 8
        n_index = max(1, math.ceil(index_bytes / block_bytes))
        n_parts = max(1, math.ceil(index_bytes / wanted_bytes))
    if 0 in sizes:
        n_queries = max(1, math.ceil(sizes[0]["n"] * sizes[0]["width"] * 8 / block_bytes))
        n_queries = max(n_queries, min(math.ceil(cores / n_index), sizes[0]["n"] // LEAST_QUERIES))
    left = packed.where("side = 0").select("*", _dealt(n_queries, "q"), _every(n_index, "i"))
    # other columns by the same names: a cogroup of a table with itself mixes up the two sides
    right = packed.toDF(*packed.columns).where("side = 1")
    # a block is made of whole parts, the blocks as wanted: of an id that repeats, each part leaves out one
    right = right.select("*", _dealt(n_parts, "part"), _every(n_queries, "q"))
    right = right.withColumn("i", F.col("part") % n_index)
    tile = _tile(exclude_self, max(1, math.isqrt(n_index)))
    tiles = left.groupBy("q", "i").cogroup(right.groupBy("q", "i")).applyInArrow(tile, TILE_SCHEMA)

    # both steps group by query inside one partitioning by query
    merged = tiles.repartition("query_id")
    for by in (("query_id", "branch"), ("query_id",)):
        best = F.array_sort(F.flatten(F.collect_list("matches")))
        merged = merged.groupBy(*by).agg(
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.slice(best, 1, F.max("depth")).alias("matches"),
            F.max("depth").alias("depth"),
        )
    return merged.drop("depth")


def top_matches(
    queries: DataFrame,
    index: DataFrame,
    exclude_self: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(query_id, product_id, score, rank, low, high): :func:`match_lists`, a row per match."""
    found = match_lists(queries, index, exclude_self, block_bytes)
    return found.select(
        "query_id", "low", "high", F.posexplode("matches").alias("position", "match")
    ).select(
        "query_id",
        "match.product_id",
        (-F.col("match.loss")).alias("score"),
        (F.col("position") + 1).alias("rank"),
        "low",
        "high",
    )


def _block_bytes(tables: list[int], wanted: int) -> int:
    """The size of a block for tables of so many bytes: as wanted, while few blocks do."""
    enough = math.ceil(max(tables, default=0) / MOST_COPIES)
    return max(wanted, min(enough, BLOCK_BYTES))


def _dealt(n: int, name: str) -> Column:
    """The block of a chunk."""
    return F.pmod(F.xxhash64(F.col("ids")), F.lit(n)).cast("int").alias(name)


def _every(n: int, name: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)


def _usable(df: DataFrame, key: str, *more: Column) -> DataFrame:
    vector = F.col("vector").cast("array<double>")
    some = df.select(F.col(key).cast("string").alias(key), vector.alias("vector"), *more)
    return some.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)))


def _packer(side: int, block_bytes: int):
    """Rows of an id, a vector and a depth as chunks; all vectors of a chunk are as long."""
    most = CHUNK_ROWS

    import numpy as np
    import pyarrow as pa

    def pack(batches):
        for batch in batches:
            lengths = np.diff(batch.column("vector").offsets.to_numpy())
            cuts = np.flatnonzero(np.diff(lengths)) + 1
            for first, last in zip((0, *cuts), (*cuts, batch.num_rows)):
                width = int(lengths[first]) if last > first else 0
                rows = min(most, max(1, block_bytes // (32 * max(width, 1))))
                for at in range(first, last, rows):
                    part = batch.slice(at, min(rows, last - at))
                    n = part.num_rows
                    whole = pa.array([0, n], pa.int32())
                    vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(pa.array([x], pa.int32()) for x in (side, n, width)),
                            pa.ListArray.from_arrays(whole, part.column("id").cast(pa.string())),
                            pa.ListArray.from_arrays(whole, part.column("depth")),
                            pa.array([vectors.tobytes()], pa.binary()),
                        ],
                        ["side", "n", "width", "ids", "depths", "vectors"],
                    )

    return pack


def _tile(exclude_self: bool, n_branches: int):
    """The code that runs inside the tasks, closed over its settings.

    It is defined inside a function so that it reaches the Python workers by value and they need
    no copy of this package.
    """
    cells_per_step, chunk_rows, group_scores = CELLS_PER_STEP, CHUNK_ROWS, GROUP_SCORES
    scale = 10.0**SCORE_DIGITS

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    entry = pa.struct([("loss", pa.float64()), ("product_id", pa.string())])
    schema = pa.schema(
        [("query_id", pa.string()), ("branch", pa.int32()), ("depth", pa.int32()), ("low", pa.float64()),
         ("high", pa.float64()), ("matches", pa.list_(entry))]
    )

    def unpacked(table):
        """Ids and vectors of chunks; the vectors of the index are all as long."""
        ids = pa.concat_arrays([c.flatten() for c in table.column("ids").chunks])
        flat = np.frombuffer(b"".join(v.as_buffer() for v in table.column("vectors")), np.float64)
        return ids, flat.reshape(len(ids), -1)

    def rounded(scores):
        return np.floor(scores * scale + 0.5) / scale

    def bars(scores, k):
        """At most the ``k``-th best score of each row: so many groups of a row reach it."""
        size = min(group_scores, scores.shape[1] // (4 * k))
        if size < 2:
            at = scores.shape[1] - k
            return np.partition(scores, at, axis=1)[:, at]
        n = scores.shape[1] // size
        highest = scores[:, : n * size].reshape(-1, size, n).max(axis=1)
        return np.partition(highest, n - k, axis=1)[:, n - k]

    def repeats(ids, parts):
        """Where an id that occurs before is the first one of its part, and where that id occurs first."""
        first = pc.index_in(ids, value_set=ids).to_numpy()
        if (first == np.arange(len(ids))).all():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        _, at = np.unique(first * np.int64(parts.max() + 1) + parts, return_index=True)
        at = np.sort(at[first[at] != at])
        return at, first[at]

    def best(ids, matrix, again, query_ids, vectors, depths):
        """The best rows of each query as batches; a smaller position in ``ids`` wins a tie."""
        n = len(ids)
        step = max(1, cells_per_step // n)
        for start in range(0, len(query_ids), step):
            part = slice(start, start + step)
            wanted = np.minimum(depths[part], n)
            scores = vectors[part] @ matrix.T
            low, high = rounded(scores.min(axis=1)), rounded(scores.max(axis=1))
            usual = np.isfinite(low).all() and np.isfinite(high).all()
            if not usual:
                scores = rounded(scores)
            if exclude_self:
                own = pc.index_in(query_ids[part], value_set=ids)
                own = own.fill_null(-1).to_numpy(zero_copy_only=False)
                rows = np.flatnonzero(own >= 0)
                scores[rows, own[rows]] = -np.inf
                at, first = again
                low_at, n_more = np.searchsorted(first, own), np.searchsorted(first, own, "right")
                n_more -= low_at
                more = np.arange(n_more.sum()) - np.repeat(np.cumsum(n_more) - n_more - low_at, n_more)
                scores[np.repeat(np.arange(len(own)), n_more), at[more]] = -np.inf
            k = max(int(wanted.max()), 1)
            # everything that reaches the k-th best score once rounded, ties included, and little more
            if usual:
                bar = bars(scores, k)
                bar -= 2 / scale + 1e-12 * np.abs(bar)
            else:
                bar = np.partition(scores, n - k, axis=1)[:, n - k]
            row, position = np.divmod(np.flatnonzero(scores >= bar[:, None]), n)
            score = scores[row, position]
            score = rounded(score) if usual else score
            finite = np.isfinite(score)
            row, position, score = row[finite], position[finite], score[finite]
            order = np.lexsort((position, -score, row))
            row, position, score = row[order], position[order], score[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row) + 1
            keep = rank <= wanted[row]
            row, position, score = row[keep], position[keep], score[keep]
            ends = np.searchsorted(row, np.arange(len(wanted) + 1)).astype(np.int32)
            matches = pa.StructArray.from_arrays(
                [pa.array(-score), ids.take(pa.array(position)).cast(pa.string())], fields=list(entry)
            )
            yield query_ids[part], depths[part], low, high, pa.ListArray.from_arrays(pa.array(ends), matches)

    def run(left, right):
        tables = [schema.empty_table()]
        if not len(left) or not len(right):
            return tables[0]
        ids, matrix = unpacked(right)
        order = pc.sort_indices(ids)  # in id order, so that a smaller position wins a tie
        ids, matrix = ids.take(order), matrix[order.to_numpy()]
        parts = np.repeat(right.column("part").to_numpy(), right.column("n").to_numpy())[order.to_numpy()]
        again = repeats(ids, parts) if exclude_self else None
        branch = right.column("i")[0].as_py() % n_branches
        for width in pc.unique(left.column("width")).to_pylist():
            if width != matrix.shape[1]:
                raise ValueError(f"a query has {width} elements, the index {matrix.shape[1]}")
        # small chunks are taken together
        ends = np.cumsum(left.column("n").to_numpy())
        row = 0
        while row < len(left):
            end = int(np.searchsorted(ends, (ends[row - 1] if row else 0) + chunk_rows, side="right"))
            end = max(end, row + 1)
            chunk, row = left.slice(row, end - row), end
            query_ids, vectors = unpacked(chunk)
            depths = pa.concat_arrays([c.flatten() for c in chunk.column("depths").chunks])
            depths = depths.to_numpy(zero_copy_only=False)
            for found_ids, wanted, low, high, matches in best(ids, matrix, again, query_ids, vectors, depths):
                arrays = [found_ids, pa.array(np.full(len(wanted), branch, np.int32)), pa.array(wanted)]
                arrays += [pa.array(low), pa.array(high), matches]
                tables.append(pa.table(arrays, schema=schema))
        return pa.concat_tables(tables)

    return run
