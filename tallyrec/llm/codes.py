"""Vector codes: each part of a vector is replaced by the number of its nearest codebook entry.

The nearest entry is found by equal-average search. Entries are sorted by the sum of their
components. A part looks at the entries outwards from its own sum, and because the squared gap
between two sums, over the number of components, is never above the squared distance, it stops
once that bound strictly exceeds the best distance found.

Codebooks are refined in rounds. The tasks of a round leave counts and sums per entry; what meets on
the driver is ``n_entries`` numbers per component, whatever the size of the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrec.llm.search import quantized
from tallyrec.llm.vectors import as_doubles, is_finite, matrix
from tallyrec.session import materialize

SCALE = 256
N_PARTS = 16
N_ENTRIES = 64
ROUNDS = 2
MAX_LENGTHS = 64  # different vector lengths in a table, each of which has codebooks of its own
STEP_ROWS = 8192  # vectors searched at a time

_LONG = np.iinfo(np.int64)

# The codebooks of vectors of one length: an array (entries, length) of whole numbers.
Books = dict[int, np.ndarray]


def bounds(length: int, n_parts: int) -> list[tuple[int, int]]:
    """First and last component of the parts, equal if the length is a multiple of ``n_parts``."""
    ends = [p * length // n_parts for p in range(n_parts + 1)]
    return list(zip(ends, ends[1:]))


def nearest_entries(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row of ``parts`` the number of its nearest entry, the squared distance to it, and
    for all together how many distances were computed.

    Lower numbers win ties. Numbers too large for 64-bit sums are computed as Python integers.
    """
    n, width = parts.shape
    largest = max((int(abs(f(x))) for x in (parts, entries) if x.size for f in (np.min, np.max)), default=0)
    kind = np.int64 if (2 * largest + 1) * max(width, 1) < 1 << 30 else object
    parts, entries = parts.astype(kind), entries.astype(kind)
    order = np.argsort(entries.sum(axis=1), kind="stable")
    by_sum, sums = entries[order], entries.sum(axis=1)[order]
    own = parts.sum(axis=1)
    high = np.searchsorted(sums, own)
    low = high - 1
    beyond = width * (2 * largest) ** 2 + 1
    best = np.full(n, beyond, dtype=kind)
    code = np.full(n, len(entries), np.int64)
    rows = np.arange(n)
    computed = 0
    while len(rows):
        below, above, mine = low[rows], high[rows], own[rows]
        can_sink, can_rise = below >= 0, above < len(sums)
        gap_below = mine - sums[np.maximum(below, 0)]
        gap_above = sums[np.minimum(above, len(sums) - 1)] - mine
        sinks = can_sink & (~can_rise | (gap_below <= gap_above))
        gap = np.where(sinks, gap_below, gap_above)
        open_ = (can_sink | can_rise) & ~(gap * gap > width * best[rows])
        rows, sinks = rows[open_], sinks[open_]
        at = np.where(sinks, below[open_], above[open_])
        apart = parts[rows] - by_sum[at]
        distance = (apart * apart).sum(axis=1)
        computed += len(rows)
        number = order[at]
        better = (distance < best[rows]) | ((distance == best[rows]) & (number < code[rows]))
        best[rows[better]], code[rows[better]] = distance[better], number[better]
        low[rows[sinks]] -= 1
        high[rows[~sinks]] += 1
    return code, best, computed


def _encode(vectors: np.ndarray, book: np.ndarray, n_parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The entry number of each part of each vector, and the squared distance of all parts."""
    codes = np.zeros((len(vectors), n_parts), np.int64)
    error = np.zeros(len(vectors), object)
    for part, (first, last) in enumerate(bounds(vectors.shape[1], n_parts)):
        codes[:, part], distance, _ = nearest_entries(vectors[:, first:last], book[:, first:last])
        error = error + distance
    return codes, error


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches of a bounded number of vectors of one length."""
    for batch in batches:
        for length in pc.unique(batch.column("dim")).to_pylist():
            own = batch.filter(pc.equal(batch.column("dim"), length))
            for at in range(0, own.num_rows, STEP_ROWS):
                yield length, own.slice(at, STEP_ROWS)


def _sums(books: Books, n_parts: int) -> Callable:
    """Per entry and component, how many parts chose the entry and the sum of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {d: np.zeros((n_parts, len(b)), np.int64) for d, b in books.items()}
        totals = {d: np.zeros(b.shape, object) for d, b in books.items()}
        for length, batch in _by_length(batches):
            vectors, book = matrix(batch.column("vector"), length), books[length]
            codes, _ = _encode(vectors, book, n_parts)
            whole = vectors.size and float(np.abs(vectors.astype(float)).max()) * len(vectors) >= 2.0**52
            for part, (first, last) in enumerate(bounds(length, n_parts)):
                own = codes[:, part]
                counts[length][part] += np.bincount(own, minlength=len(book))
                for place in range(first, last):
                    if whole:
                        np.add.at(totals[length][:, place], own, vectors[:, place].astype(object))
                    else:
                        sums = np.bincount(own, weights=vectors[:, place], minlength=len(book))
                        totals[length][:, place] += sums.astype(np.int64).astype(object)
        for length, total in totals.items():
            for part, (first, last) in enumerate(bounds(length, n_parts)):
                used = np.flatnonzero(counts[length][part])
                for place in range(first, last) if len(used) else ():
                    arrays = [
                        pa.array(np.full(len(used), length, np.int32)),
                        pa.array(np.full(len(used), place, np.int32)),
                        pa.array(used.astype(np.int32)),
                        pa.array(counts[length][part][used]),
                        pa.array([Decimal(int(x)) for x in total[used, place]], pa.decimal128(38, 0)),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, ["dim", "place", "entry", "n", "total"])

    return run


def _codes(books: Books, digests: dict[int, str], n_parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, batch in _by_length(batches):
            codes, error = _encode(matrix(batch.column("vector"), length), books[length], n_parts)
            digits = [bytes(row).hex() for row in codes.astype(np.uint8)]
            error = np.minimum(error, _LONG.max).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    batch.column("dim"),
                    pa.array(digits, pa.string()),
                    pa.array(error),
                    pa.array([digests[length]] * len(digits), pa.string()),
                ],
                ["vec_id", "label", "dim", "code", "error", "codebooks_sha256"],
            )

    return run


def _refined(books: Books, found: list) -> Books:
    """Entries that some part chose become the floor of the mean of those parts."""
    books = {length: book.copy() for length, book in books.items()}
    for row in found:
        books[row["dim"]][row["entry"], row["place"]] = int(row["total"]) // row["n"]
    return books


def digest(book: np.ndarray, n_parts: int) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    parts = (book[:, first:last].ravel() for first, last in bounds(book.shape[1], n_parts))
    return hashlib.sha256(",".join(str(int(x)) for p in parts for x in p).encode()).hexdigest()


class Compressed(NamedTuple):
    """Codes of the vectors, and the codebooks by vector length, entry and part."""

    codes: DataFrame
    codebooks: DataFrame


def compress_vectors(
    vectors: DataFrame,
    n_parts: int = N_PARTS,
    n_entries: int = N_ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Compressed:
    """Code every row of ``vec_id``, ``label`` and ``embedding`` by codebooks fitted to all rows.

    Components become ``floor(scale * x)``, held at the limits of a long, and a vector is cut into
    ``n_parts`` consecutive parts. The codebook of a part starts as that part of the ``n_entries``
    rows with the smallest ids (null ids last, equal ids in the order of their vectors; fewer
    entries where there are fewer rows). In each round all parts choose their nearest entry, and an
    entry becomes the floor of its parts' mean; one that nobody chose stays.

    ``codes`` has ``vec_id``, ``code`` (two hex digits per part), ``error`` (squared distances over
    all parts), ``label_error`` (errors over rows with an equal label, nulls together), both held
    at the largest long, ``codebooks_sha256``, ``label`` and ``dim``, one row per usable row,
    repeated ones included. ``codebooks`` has ``dim``, ``entry``, ``part`` and ``components``.

    Rows whose vector is null or holds null or non-finite components are dropped. Vectors of
    another length have codebooks of their own, up to ``MAX_LENGTHS`` lengths; more are an error.
    The parts of a length that is no multiple of ``n_parts`` differ by one component, and an empty
    vector has code zero. Other columns are ignored; an empty table gives empty tables.
    """
    if not 1 <= n_entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    spark = vectors.sparkSession
    slim = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", as_doubles("embedding").alias("vector")
    )
    slim = slim.where(is_finite(F.col("vector"))).withColumn("dim", F.size("vector"))
    rows = materialize(slim.withColumn("vector", quantized(F.col("vector"), scale)), "codes-rows")

    lengths = rows.select("dim").distinct().limit(MAX_LENGTHS + 1).collect()
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"the vectors have more than {MAX_LENGTHS} different lengths")
    order = Window.partitionBy("dim").orderBy(F.asc_nulls_last("vec_id"), "vector")
    number = F.row_number().over(order)
    first = rows.select("dim", "vec_id", "vector").withColumn("entry", number)
    starts: dict[int, list] = {}
    for row in first.where(F.col("entry") <= n_entries).orderBy("dim", "entry").collect():
        starts.setdefault(row["dim"], []).append(row["vector"])
    books = {d: np.array(v, np.int64).reshape(len(v), d) for d, v in starts.items()}

    for _ in range(rounds if books else 0):
        sums = rows.select("dim", "vector").mapInArrow(
            _sums(books, n_parts), "dim int, place int, entry int, n long, total decimal(38,0)"
        )
        sums = sums.groupBy("dim", "place", "entry").agg(
            F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")
        )
        books = _refined(books, sums.collect())

    digests = {length: digest(book, n_parts) for length, book in books.items()}
    schema = rows.select("vec_id", "label", "dim").schema
    for name, kind in (("code", "string"), ("error", "long"), ("codebooks_sha256", "string")):
        schema = schema.add(name, kind)
    codes = materialize(rows.mapInArrow(_codes(books, digests, n_parts), schema), "codes")
    together = F.sum(F.col("error").cast("decimal(38,0)"))
    together = F.least(together, F.lit(_LONG.max).cast("decimal(38,0)")).cast("long")
    labels = codes.groupBy(F.col("label").alias("_label")).agg(together.alias("label_error"))
    codes = codes.join(labels, F.col("label").eqNullSafe(F.col("_label")))
    entries = [
        (length, entry, part, [int(x) for x in row[first:last]])
        for length, book in books.items()
        for entry, row in enumerate(book)
        for part, (first, last) in enumerate(bounds(length, n_parts))
    ]
    return Compressed(
        codes.select("vec_id", "code", "error", "label_error", "codebooks_sha256", "label", "dim"),
        spark.createDataFrame(entries, "dim int, entry int, part int, components array<long>"),
    )
