"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is mapped to the number of set bits in each of its sixteen 4-bit segments.
The Manhattan distance of two such count vectors never exceeds the Hamming distance of the
fingerprints. Two integer points at Manhattan distance two or less have a lattice point within one
step of both, so every fingerprint is stamped on its own grid cell and on the cells one step away;
fingerprints that meet in a cell are candidates, and their Hamming distance is then taken exactly.
A pair is tested in one of its common cells only, so no pair comes out twice.

Only distinct fingerprints are joined: copies of any number are one row there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import release_memory, unused
from tallyrec.llm.components import connected_components
from tallyrec.session import materialize

SHINGLE_WORDS = 3
SEED = 42
MAX_DISTANCE = 2  # the cells one step away cover Manhattan distances up to two
SEGMENTS, SEGMENT_BITS, COUNT_BITS = 16, 4, 3

_HASHES_AT_ONCE = 1 << 16


def simhash(text: bytes | None) -> int:
    """The unsigned fingerprint of one UTF-8 text.

    A-Z are lower-cased, words are runs of other characters than ASCII white space, and the
    64-bit hashes of the space-joined word shingles (repeats included) vote on every bit; a bit is
    set when more than half of them have it. Fewer words than a shingle form a single one; a null
    text or one without words has fingerprint zero.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE_WORDS, len(words)) - 1
    spans = zip(starts[: len(words) - width].tolist(), ends[width:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], np.uint64)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _HASHES_AT_ONCE):
        part = hashes[i : i + _HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        found = np.array([simhash(t.as_py()) for t in texts], np.uint64).view(np.int64)
        others = batch.drop_columns(["text"])
        yield pa.record_batch(
            [*others.columns, pa.array(found)], [*others.schema.names, "fingerprint"]
        )
    release_memory()


def fingerprints(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, the columns named in ``carry`` and the fingerprint of ``text`` as a signed long, one
    row per row of ``docs``."""
    slim = docs.select(F.col("doc_id").cast("long"), *carry, F.col("text").cast("string"))
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in slim.drop("text").schema.fields]
    return slim.mapInArrow(_fingerprint_batches, ", ".join([*kinds, "fingerprint long"]))


def near_pairs(distinct: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """All pairs ``a < b`` of the distinct ``fingerprint`` values that differ in few bits."""
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError(f"max_distance must be between 0 and {MAX_DISTANCE}")
    # few bytes come in and many rows go out: spread them before they multiply
    n_parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = distinct.repartition(n_parts)
    stamped = spread.select("fingerprint", F.inline(_stamps(F.col("fingerprint"))))
    # the stamps are many times as large as Spark takes them for, from the fingerprints: never broadcast
    left, right = stamped.alias("l").hint("merge"), stamped.alias("r").hint("merge")
    i, j = F.col("l.step"), F.col("r.step")
    one_cell = (i == 0) | (
        (j != 0) & ((F.abs(i) < F.abs(j)) | ((F.abs(i) == F.abs(j)) & (i != j)))
    )
    differing = F.bit_count(F.col("l.fingerprint").bitwiseXOR(F.col("r.fingerprint")))
    return left.join(
        right,
        (F.col("l.cell") == F.col("r.cell"))
        & (F.col("l.fingerprint") < F.col("r.fingerprint"))
        & one_cell
        & (differing <= max_distance),
    ).select(F.col("l.fingerprint").alias("a"), F.col("r.fingerprint").alias("b"))


def _stamps(fingerprint: Column) -> Column:
    """Cell and step of the own cell (step 0) and of the cells one step away (plus or minus the
    1-based segment). A cell packs the sixteen counts, three bits each."""
    mask = (1 << SEGMENT_BITS) - 1
    counts = [
        F.bit_count(F.shiftrightunsigned(fingerprint, SEGMENT_BITS * s).bitwiseAND(F.lit(mask)))
        for s in range(SEGMENTS)
    ]
    own = sum(
        (F.shiftleft(c.cast("long"), COUNT_BITS * s) for s, c in enumerate(counts)), F.lit(0)
    )

    def cell(value: Column, step: int) -> Column:
        return F.struct(value.cast("long").alias("cell"), F.lit(step).alias("step"))

    stamps = [cell(own, 0)]
    for s, count in enumerate(counts):
        one = 1 << (COUNT_BITS * s)
        stamps.append(F.when(count < SEGMENT_BITS, cell(own + F.lit(one), s + 1)))
        stamps.append(F.when(count > 0, cell(own - F.lit(one), -s - 1)))
    return F.filter(F.array(*stamps), lambda stamp: stamp.isNotNull())


def simhash_duplicates(docs: DataFrame) -> DataFrame:
    """Fingerprint and component of every document.

    Documents whose fingerprints differ in at most two bits are linked. Returns ``doc_id``,
    ``fingerprint`` (16 lower-case hexadecimal digits), ``component_id`` (the smallest ``doc_id``
    reachable over links, the own one included) and ``kept`` (true for the row that stands for the
    component), one row per row of ``docs``.

    Null and empty texts have fingerprint zero and are linked like any other. A null ``doc_id`` is
    never a component's id unless all of the component's are null. Of repeated rows with one
    ``doc_id`` all are returned and all are marked alike. Columns other than ``doc_id`` and
    ``text`` are ignored; an empty table gives an empty result.
    """
    marked = materialize(fingerprints(docs), "fingerprints")
    members = _members(marked, F.col("doc_id")).withColumnRenamed("least", "component_id")
    return marked.join(members, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _members(marked: DataFrame, order: Column) -> DataFrame:
    """``fingerprint`` and ``least``, the smallest ``order`` of the rows in its component."""
    classes = marked.groupBy("fingerprint").agg(F.min(order).alias("first"))
    labels = connected_components(near_pairs(classes.select("fingerprint")))
    labels = labels.withColumnRenamed("node", "fingerprint")
    rooted = classes.join(labels, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    rooted = materialize(rooted, "fingerprint-roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return rooted.join(least, "root").select("fingerprint", "least")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component of :func:`simhash_duplicates`, with all columns of ``docs``.

    The row with the smallest ``doc_id`` stays, one without an id only if no other is there, and of
    several such rows a single one. Rows are told apart by a number that is written once, so rows
    that share a ``doc_id``, or have none, are judged each by its own text. Further columns may have any
    names.
    """
    row = unused(docs.columns, "_row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    numbered = materialize(numbered, "near-documents")
    marked = materialize(fingerprints(numbered, [row]), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", row)
    members = _members(marked, order).select("fingerprint", F.col("least")[row].alias("stays"))
    gone = marked.join(members, "fingerprint").where(F.col(row) != F.col("stays"))
    return numbered.join(gone.select(row), row, "left_anti").select(*docs.columns)
