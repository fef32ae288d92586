"""Hard negatives by Fagin's threshold algorithm.

An anchor's positives are its best rows of the same label. Its negatives are the best rows of other
labels whose scores lie in a window below a positive's score. Both are found in the same way: rows
are cut into shards, anchors into blocks, and a tile of one block and one shard keeps a sorted list
of the shard's rows per dimension. An anchor reads each list from the end that its own sign prefers,
scores the rows it meets in full, and stops once the threshold - the score of a row that would stand
at the reached place of every list - is strictly below the k-th score of each of its windows, or
below the window itself. Only the best rows of each window leave a tile.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrec.llm.search import quantized
from tallyrec.llm.vectors import as_doubles, is_finite, matrix
from tallyrec.session import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW_PERCENT, HIGH_PERCENT = 50, 95
SHARD_BYTES = 4 << 20  # of the rows of a shard, as longs; a tile takes some four times that
BLOCK_BYTES = 8 << 20  # of the anchors of a block

_FIRST_STEP, _LONGEST_STEP = 16, 256  # places read of every list between two looks at the threshold
_EXACT = 2.0**52  # whole doubles up to here add without rounding
_LONG = np.iinfo(np.int64)

_FOUND = (
    "anchor_id long, anchor_key long, position int, positive_id long, positive_score long, "
    "vec_id long, score long"
)


class _Shard:
    """Rows with a sorted list per dimension."""

    def __init__(self, table: pa.Table) -> None:
        table = table.take(pc.sort_indices(table, [("vec_id", "ascending")]))  # null ids last
        self.ids = table["vec_id"].combine_chunks()
        self.known = self.ids.is_valid().to_numpy(zero_copy_only=False)
        self.numbers = self.ids.fill_null(0).to_numpy()
        self.labels = table["label"].to_numpy()
        self.size = len(table)
        rows = matrix(table["vector"], table["dim"][0].as_py())
        self.largest = float(np.abs(rows.astype(float)).max(initial=0))
        self.rows = rows.astype(float) if self.largest < _EXACT else rows.astype(object)
        self.lists = np.argsort(rows, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(self.rows.T, self.lists, axis=1)

    def for_anchor(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The anchor, the rows and their sorted values in a type that adds without rounding."""
        most = self.largest * float(np.abs(anchor.astype(float)).max(initial=0)) * len(anchor)
        kind = float if most < _EXACT else object
        if kind is object:  # through int: whole numbers of any size
            whole = np.vectorize(int, otypes=[object])
            return anchor.astype(object), whole(self.rows), whole(self.sorted)
        return anchor.astype(float), self.rows, self.sorted


def _held(scores: np.ndarray) -> np.ndarray:
    """Whole scores as longs, held at the limits of a long."""
    return np.clip(scores, _LONG.min, _LONG.max).astype(np.int64)


class _Best:
    """The best ``k`` rows with scores from ``low`` to ``high``."""

    def __init__(self, low: int, high: int, k: int) -> None:
        self.low, self.high, self.k = low, high, k
        self.rows, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, rows: np.ndarray, scores: np.ndarray) -> None:
        inside = (scores >= self.low) & (scores <= self.high)
        if inside.any():
            rows = np.concatenate((self.rows, rows[inside]))
            scores = np.concatenate((self.scores, scores[inside]))
            order = np.lexsort((rows, ~scores))[: self.k]  # ~ turns the order round, limits too
            self.rows, self.scores = rows[order], scores[order]

    def is_final(self, threshold: int) -> bool:
        """Whether no row with a score up to ``threshold`` can change anything."""
        full = len(self.rows) == self.k
        return threshold < self.low or full and threshold < self.scores[-1]


def threshold_search(
    shard: _Shard, anchor: np.ndarray, eligible: np.ndarray, windows: list[_Best]
) -> int:
    """Fill ``windows`` with the anchor's best eligible rows; returns how many rows were scored."""
    weights, rows, heads = shard.for_anchor(anchor)
    dims = np.flatnonzero(anchor)
    n = shard.size
    if not len(dims):  # all rows score 0
        found = np.flatnonzero(eligible)
        for window in windows:
            window.add(found, np.zeros(len(found), np.int64))
        return len(found)
    weights, from_top = weights[dims], anchor[dims] > 0
    seen = np.zeros(n, bool)
    place, step, scored = 0, _FIRST_STEP, 0
    at = np.where(from_top, n - 1, 0)
    while place < n and not seen.all():
        threshold = int(_held(np.array([(weights * heads[dims, at]).sum()]))[0])
        windows = [w for w in windows if not w.is_final(threshold)]
        if not windows:
            break
        end = min(place + step, n)
        reached = np.arange(place, end)
        columns = np.where(from_top[:, None], n - 1 - reached, reached)
        met = np.zeros(n, bool)
        met[shard.lists[dims[:, None], columns]] = True
        fresh = np.flatnonzero(met & ~seen & eligible)
        seen |= met
        if len(fresh):
            scores = _held(rows[fresh][:, dims] @ weights)
            scored += len(fresh)
            for window in windows:
                window.add(fresh, scores)
        at = columns[:, -1]
        place, step = end, min(2 * step, _LONGEST_STEP)
    return scored


def _tile(own_label: bool, k: int, low: int, high: int) -> Callable:
    """One block of anchors against one shard: the rows of each window that may be among the best."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        kinds = [("anchor_id", pa.int64()), ("anchor_key", pa.int64()), ("position", pa.int32())]
        kinds += [(n, pa.int64()) for n in ("positive_id", "positive_score", "vec_id", "score")]
        schema = pa.schema(kinds)
        tables = [schema.empty_table()]
        if not len(anchors) or not len(rows):
            return tables[0]
        shard = _Shard(rows)
        vectors = matrix(anchors["vector"], anchors["dim"][0].as_py())
        labels = anchors["label"].to_numpy()
        ids, keys = anchors["anchor_id"].to_numpy(), anchors["anchor_key"].to_numpy()
        positives = [None] * len(ids) if own_label else anchors["positives"].to_pylist()
        for i, anchor in enumerate(vectors):
            eligible = (shard.labels == labels[i]) == own_label
            eligible &= (shard.numbers != ids[i]) | ~shard.known
            if own_label:
                windows = [_Best(_LONG.min, _LONG.max, k)]
            else:
                scores = [p["score"] for p in positives[i]]
                windows = [_Best(-(-low * s // 100), high * s // 100, k) for s in scores]
            threshold_search(shard, anchor, eligible, windows)
            for position, window in enumerate(windows):
                n = len(window.rows)
                positive = {"id": None, "score": None} if own_label else positives[i][position]
                arrays = [
                    pa.array(np.full(n, ids[i])),
                    pa.array(np.full(n, keys[i])),
                    pa.array(np.full(n, position, np.int32)),
                    pa.array([positive["id"]] * n, pa.int64()),
                    pa.array([positive["score"]] * n, pa.int64()),
                    shard.ids.take(pa.array(window.rows)),
                    pa.array(window.scores),
                ]
                if n:
                    tables.append(pa.table(arrays, schema=schema))
        return pa.concat_tables(tables)

    return run


def _search(
    anchors: DataFrame, rows: DataFrame, by: list[str], tile: Callable, shard_bytes: int, block_bytes: int
) -> DataFrame:
    """The tiles of anchors and rows that agree in ``by``.

    A group of equal ``by`` has as many shards and blocks as its rows and anchors fill, so a label
    or a vector that most rows share is spread like any other.
    """
    filled = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
    asked = anchors.groupBy(*by).agg(F.count(F.lit(1)).alias("n_anchors"))
    width = F.greatest(F.col("dim"), F.lit(1)) * F.lit(8)

    def number(n: str, size: int):
        return F.ceil(F.col(n) * width / F.lit(float(size))).cast("int")

    sizes = filled.join(asked, by).select(
        *by,
        number("n_rows", shard_bytes).alias("n_shards"),
        number("n_anchors", block_bytes).alias("n_blocks"),
    )

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    # the row number deals equal ids and equal vectors apart, too
    shards = rows.withColumn("number", F.monotonically_increasing_id()).join(sizes, by)
    dealt = F.pmod(F.xxhash64("number"), F.col("n_shards")).cast("int")
    shards = shards.withColumn("shard", dealt).withColumn("block", every("n_blocks"))
    dealt = F.pmod(F.xxhash64("anchor_id", "anchor_key"), F.col("n_blocks")).cast("int")
    blocks = anchors.join(sizes, by).withColumn("block", dealt).withColumn("shard", every("n_shards"))
    key = [*by, "shard", "block"]
    drop = ("n_shards", "n_blocks")
    both = blocks.drop(*drop).groupBy(*key).cogroup(shards.drop("number", *drop).groupBy(*key))
    return both.applyInArrow(tile, _FOUND)


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The best ``k`` rows of each list, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _usable(vectors: DataFrame, scale: int) -> DataFrame:
    slim = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        as_doubles("embedding").alias("vector"),
    )
    slim = slim.where(F.col("label").isNotNull() & is_finite(F.col("vector")))
    return slim.select(
        "vec_id", "label", F.size("vector").alias("dim"), quantized(F.col("vector"), scale).alias("vector")
    )


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
    scale: int = SCALE,
    shard_bytes: int = SHARD_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The hard negatives in ``vectors`` of each row of ``anchors``.

    Both tables have ``vec_id``, a whole ``label`` and ``embedding``; components become
    ``floor(scale * x)`` and a score is an inner product of those. An anchor's positives are its
    first ``positives`` other rows of its label, higher scores first, ties by ``vec_id``. For each of
    them the first ``negatives`` rows of other labels are returned whose scores lie between
    ``low_percent`` and ``high_percent`` of the positive's, both included: ``anchor_id``,
    ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.
    All are returned where there are fewer, and an anchor or positive without any has no row.

    Rows with a null label or vector, or with null or non-finite components, take no part, and
    vectors of different lengths are not compared. Rows with the anchor's ``vec_id`` are not its
    candidates; a null ``vec_id`` is no anchor, but a candidate, last among equal scores. Repeated
    candidate rows all count; equal anchors are answered once, and an id that comes with two labels
    or vectors is two anchors. Scores and components are held at the limits of a long. Other columns
    are ignored; empty tables give an empty result.
    """
    rows = materialize(_usable(vectors, scale), "negatives-rows")
    asked = _usable(anchors, scale).where(F.col("vec_id").isNotNull()).distinct()
    asked = asked.withColumn("anchor_key", F.xxhash64("label", "vector"))
    asked = materialize(asked.withColumnRenamed("vec_id", "anchor_id"), "negatives-anchors")
    sizes = (shard_bytes, block_bytes)

    same = _tile(True, positives, low_percent, high_percent)
    found = _search(asked, rows, ["dim", "label"], same, *sizes)
    best = _first(found, positives, "anchor_id", "anchor_key")
    entry = F.struct("rank", F.col("vec_id").alias("id"), "score")
    lists = best.groupBy("anchor_id", "anchor_key").agg(F.collect_list(entry).alias("positives"))
    lists = lists.withColumn("positives", F.array_sort("positives"))  # at most ``positives`` each
    known = materialize(asked.join(lists, ["anchor_id", "anchor_key"]), "negatives-positives")

    other = _tile(False, negatives, low_percent, high_percent)
    found = _search(known, rows, ["dim"], other, *sizes)
    return _first(found, negatives, "anchor_id", "anchor_key", "position").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
