"""Near-duplicate vectors by a pivot-permutation index.

Every distinct vector is described by its ``PREFIX`` nearest reference points out of ``PIVOTS``, in
order of nearness. Two vectors are compared when their descriptions share at least ``SHARED``
pivots; such a pair also shares one of the ``PREFIX - SHARED + 1`` lowest-numbered pivots of each, so
only those lists are written to the inverted index. Inside a list shared pivots are counted, and
cosines taken, as matrix products. A pair is judged in the list of its lowest common pivot only.

A list longer than ``BLOCK`` rows is cut into blocks by a hash, and each pair of blocks is a group of
its own, so memory is bounded however many vectors lie near one pivot. A group never emits pairs: it
returns, per vector, the number of links found and the smallest vector reachable inside the group.

The reference points are the fit of the index: of the ``CANDIDATES`` vectors with the smallest hashes,
up to ``PIVOTS`` of which no two lie within twice the angle of a link. So a large group of similar
vectors holds about one of them, and far points order its members, which see them much alike; were
many points inside the group, their order would be noise. Seeded random points fill up what is missing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.components import connected_components
from tallyrec.llm.vectors import as_doubles, is_finite, matrix, unit_rows
from tallyrec.session import materialize

PIVOTS = 128
CANDIDATES = 2048
PREFIX = 16
SHARED = 6
BLOCK = 2048
MIN_COSINE = 0.93
SEED = 7


def vector_classes(vectors: DataFrame) -> DataFrame:
    """Distinct usable vectors per label: ``class_id``, ``label``, ``dim``, ``vector``, ``size``
    (rows) and ``first`` (smallest ``vec_id``). Zero vectors and null labels are left out."""
    slim = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", as_doubles("embedding").alias("vector")
    )
    usable = slim.where(
        F.col("label").isNotNull() & is_finite(F.col("vector")) & F.exists("vector", lambda x: x != 0)
    )
    classes = usable.groupBy("label", "vector").agg(
        F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("first")
    )
    return materialize(
        classes.select(
            F.monotonically_increasing_id().alias("class_id"),
            "label",
            F.size("vector").alias("dim"),
            "vector",
            "size",
            "first",
        ),
        "vector-classes",
    )


def sample_pivots(
    classes: DataFrame, n_pivots: int = PIVOTS, min_cosine: float = MIN_COSINE
) -> dict[int, np.ndarray]:
    """The reference points by vector length, at most ``n_pivots`` of each."""
    rows = classes.orderBy(F.xxhash64("vector"), "class_id").limit(CANDIDATES).select("vector")
    found: dict[int, list] = {}
    for (vector,) in rows.collect():
        found.setdefault(len(vector), []).append(vector)
    return {dim: _thinned(unit_rows(np.array(some)), n_pivots, min_cosine) for dim, some in found.items()}


def _thinned(units: np.ndarray, n_pivots: int, min_cosine: float) -> np.ndarray:
    """The first ``n_pivots`` rows that are more than twice the angle of a link from each other."""
    nearest = 2 * min_cosine**2 - 1
    kept: list[int] = []
    for i, unit in enumerate(units):
        if len(kept) == n_pivots:
            break
        if (units[kept] @ unit < nearest).all():
            kept.append(i)
    return units[kept]


def _points(pivots: dict[int, np.ndarray], dim: int, n_pivots: int) -> np.ndarray:
    own = pivots.get(dim, np.empty((0, dim)))
    rng = np.random.default_rng([SEED, dim])
    fill = rng.standard_normal((n_pivots - len(own), dim))
    return np.vstack([own, unit_rows(fill)]) if len(fill) else own


def _describe(pivots: dict[int, np.ndarray], n_pivots: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            nearest = np.zeros((len(dims), PREFIX), np.int32)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                some = matrix(batch.column("vector").take(pa.array(rows)), int(dim))
                near = unit_rows(some) @ _points(pivots, int(dim), n_pivots).T
                nearest[rows] = np.argsort(-near, axis=1, kind="stable")[:, :PREFIX]
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(dims) + 1, dtype=np.int32) * PREFIX), pa.array(nearest.ravel())
            )
            names = [*batch.schema.names, "nearest"]
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names)

    return run


def describe(
    classes: DataFrame, n_pivots: int = PIVOTS, min_cosine: float = MIN_COSINE
) -> DataFrame:
    """The classes with ``nearest``, their nearest pivots in order of nearness."""
    pivots = sample_pivots(classes, n_pivots, min_cosine)
    kind = f"{classes.select('label').schema[0].dataType.simpleString()}"
    schema = (
        f"class_id long, label {kind}, dim int, vector array<double>, size long, first long, "
        "nearest array<int>"
    )
    return classes.mapInArrow(_describe(pivots, n_pivots), schema)


def _judge(n_pivots: int, min_cosine: float) -> Callable:
    def run(group: pa.Table) -> pa.Table:
        dim, pivot = group["dim"][0].as_py(), group["pivot"][0].as_py()
        ids = group["class_id"].to_numpy()
        blocks, sizes = group["block"].to_numpy(), group["size"].to_numpy()
        units = unit_rows(matrix(group["vector"], dim))
        nearest = matrix(group["nearest"], PREFIX)
        held = np.zeros((len(ids), n_pivots), np.float32)
        np.put_along_axis(held, nearest.astype(np.int64), 1, axis=1)
        lists = np.sort(nearest, axis=1)[:, : PREFIX - SHARED + 1].astype(np.int64)
        lower = np.zeros_like(held)
        np.put_along_axis(lower, lists, 1, axis=1)
        lower[:, pivot:] = 0
        one_block = blocks.min() == blocks.max()
        left = np.arange(len(ids)) if one_block else np.flatnonzero(blocks == blocks.min())
        right = left if one_block else np.flatnonzero(blocks == blocks.max())
        linked = (held[left] @ held[right].T >= SHARED) & (lower[left] @ lower[right].T == 0)
        linked &= units[left] @ units[right].T >= min_cosine
        if one_block:
            np.fill_diagonal(linked, False)
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, left, linked @ sizes[right])
        if not one_block:
            np.add.at(links, right, linked.T @ sizes[left])
        some = np.flatnonzero(links)
        roots = _least_linked(linked, ids, left, right)
        found = [pa.array(column[some]) for column in (ids, links, roots)]
        return pa.table(found, ["class_id", "links", "root"])

    return run


def _least_linked(
    linked: np.ndarray, ids: np.ndarray, left: np.ndarray, right: np.ndarray
) -> np.ndarray:
    """For each row the smallest id in its component inside the group."""
    least, none = ids.copy(), np.iinfo(np.int64).max
    while True:
        before = least.copy()
        np.minimum.at(least, left, np.where(linked, least[right], none).min(axis=1, initial=none))
        np.minimum.at(least, right, np.where(linked.T, least[left], none).min(axis=1, initial=none))
        if (before == least).all():
            return least


def link_counts(
    described: DataFrame, n_pivots: int = PIVOTS, min_cosine: float = MIN_COSINE, block: int = BLOCK
) -> DataFrame:
    """``class_id``, ``links`` (rows of other classes linked, in part) and ``root`` (a class in
    the same component), one row per class and group in which a link was found."""
    key = ["label", "dim", "pivot"]
    lists = F.slice(F.array_sort("nearest"), 1, PREFIX - SHARED + 1)
    postings = described.withColumn("pivot", F.explode(lists))
    lengths = (
        described.select("label", "dim", F.explode(lists).alias("pivot"))
        .groupBy(*key)
        .agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    dealt = (
        postings.join(lengths, key)
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
    )
    return dealt.groupBy(*key, "low", "high").applyInArrow(
        _judge(n_pivots, min_cosine), "class_id long, links long, root long"
    )


def vector_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """Links and components of vectors with equal labels and a cosine of ``min_cosine`` or more.

    Returns, one row per row of ``vectors``: ``vec_id``, ``n_links`` (other rows linked directly),
    ``component_id`` (smallest ``vec_id`` reachable, the own one included) and ``kept``.

    Vectors that are null, zero or hold null or non-finite components, and rows without a label,
    link with nothing and are their own component; so do vectors of different lengths among
    each other. Rows that repeat a ``vec_id`` are rows of their own. A null ``vec_id`` is a
    component's id only if no other is there. Columns other than ``vec_id``, ``embedding`` and
    ``label`` are ignored; an empty table gives an empty result. Every link returned is verified;
    the share of links found is a matter of the index and is measured in the tests.
    """
    classes = vector_classes(vectors)
    found = materialize(link_counts(describe(classes, min_cosine=min_cosine), min_cosine=min_cosine), "vector-links")
    labels = connected_components(found.select("class_id", "root"), "class_id", "root")
    labels = labels.withColumnRenamed("node", "class_id")
    counts = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    rooted = classes.join(labels, "class_id", "left").withColumn(
        "root", F.coalesce("root", "class_id")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    result = (
        rooted.join(least, "root")
        .join(counts, "class_id", "left")
        .select(
            F.col("label").alias("_label"),
            F.col("vector").alias("_vector"),
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            "component_id",
        )
    )
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", as_doubles("embedding").alias("vector")
    )
    return rows.join(
        result, (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")), "left"
    ).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )
