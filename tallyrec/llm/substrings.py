"""Removal of repeated passages by difference-cover anchors.

A window is ``WINDOW`` consecutive words of one document. Hashing every window of the corpus would move
several times the corpus, so shorter anchors are hashed, and only where the word position modulo
``PERIOD`` lies in ``COVER``. ``COVER`` is a difference cover: for any two positions there is a common
shift below ``PERIOD`` that takes both to covered positions. Two equal windows therefore share an
anchor of ``WINDOW - PERIOD + 1`` words at the same place inside them. Windows that contain a repeated
anchor are the only candidates. They are extended to full windows, whose 128-bit hashes tell
where each word sequence starts first; every later start is a repeat.

Hashes travel as packed arrays, one row per batch of documents and bucket of hashes. Each batch first
settles what it can by itself and sends a single representative of equal hashes, so a passage that
a third of all documents share sends one entry per batch. Exact copies of a whole document are
settled by the hashes of the texts alone and send no windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import release_memory, slices, texts
from tallyrec.session import materialize

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)  # every difference modulo 13 occurs among these
ANCHOR = WINDOW - PERIOD + 1
BUCKET_HASHES = 400_000
SEED = 1013

_ANCHOR_BITS = 48
_BYTES_PER_WORD = 6  # for the number of buckets only

_FACTORS = np.random.default_rng(SEED).integers(1, 2**63, (3, WINDOW), dtype=np.uint64) * 2 + 1


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _window_hashes(hashes: np.ndarray, length: int, factors: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` words."""
    n = len(hashes) - length + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(length):
        total += hashes[i : i + n] * factors[i]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0x9E3779B97F4A7C15)
    return total ^ (total >> np.uint64(29))


def anchor_places(n_words: int) -> np.ndarray:
    """The covered positions at which an anchor of a document of so many words starts."""
    if n_words < WINDOW:
        return np.zeros(0, np.int64)
    starts = n_words - ANCHOR + 1
    periods = np.arange(0, starts, PERIOD)[:, None]
    places = (periods + np.array(COVER)).ravel()
    return places[places < starts]


def _batch_number(counter: int) -> int:
    """The same again when a task is run again."""
    context = TaskContext.get()
    return ((context.partitionId() if context else 0) << 32) | counter


def _buckets_of(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)


def _documents(keys: list, hashes: list, counts: list) -> bytes:
    return b"".join(np.array(a, np.int64).tobytes() for a in (keys, hashes, counts))


def _read_documents(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.int64).reshape(3, -1)


_PACKED = "bucket int, batch long, docs binary, hashes binary, refs binary"


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    names = [field.split()[0] for field in _PACKED.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
    return pa.record_batch(arrays, names)


# -- repeated anchors ----------------------------------------------------------------------------


def _send_anchors(n_buckets: int) -> Callable:
    """Per batch of documents: its anchors by bucket, and a row with its documents and with the
    anchors that are known to be repeated because the batch holds them twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for counter, batch in enumerate(slices(batches, "text")):
            counts, found = [], []
            for text in texts(batch, "text"):
                words = text.split()
                counts.append(len(words))
                if len(words) >= WINDOW:
                    runs = _window_hashes(word_hashes(words), ANCHOR, _FACTORS[2])
                    found.append(runs[anchor_places(len(words))])
            hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
            hashes &= ~np.uint64((1 << (64 - _ANCHOR_BITS)) - 1)
            order = np.argsort(hashes, kind="stable")
            sorted_ = hashes[order]
            first = np.ones(len(sorted_), bool)
            first[1:] = sorted_[1:] != sorted_[:-1]
            repeated = ~first
            repeated[:-1] |= ~first[1:]
            number = _batch_number(counter)
            docs = _documents(batch.column("key").to_pylist(), batch.column("hash").to_pylist(), counts)
            known = order[repeated].astype(np.uint32).tobytes()
            rows = [(-1 - number % n_buckets, number, docs, None, known)]
            refs, sorted_ = order[first].astype(np.uint32), sorted_[first]
            ends = np.searchsorted(_buckets_of(sorted_, n_buckets), np.arange(n_buckets + 1))
            for bucket in np.flatnonzero(np.diff(ends)).tolist():
                own = slice(ends[bucket], ends[bucket + 1])
                short = sorted_[own] >> np.uint64(64 - _ANCHOR_BITS)
                packed = (short >> np.uint64(16)).astype(np.uint32).tobytes()
                packed += (short & np.uint64(0xFFFF)).astype(np.uint16).tobytes()
                rows.append((bucket, number, None, packed, refs[own].tobytes()))
            yield _packed(rows)
        release_memory()

    return run


_MARKED = "batch long, docs binary, refs binary"


def _marked(batch: list, docs: list, refs: list) -> pa.Table:
    arrays = [pa.array(batch, pa.int64()), pa.array(docs, pa.binary()), pa.array(refs, pa.binary())]
    return pa.table(arrays, ["batch", "docs", "refs"])


def _passed_on(group: pa.Table) -> pa.Table:
    return group.select(["batch", "docs", "refs"])


def _find_repeated(group: pa.Table) -> pa.Table:
    """One bucket: the anchors whose hash comes from more than one batch."""
    if group["bucket"][0].as_py() < 0:
        return _passed_on(group)
    parts, numbers = [], group["batch"].to_pylist()
    refs = [np.frombuffer(r, np.uint32) for r in group["refs"].to_pylist()]
    for blob, own in zip(group["hashes"].to_pylist(), refs, strict=True):
        high = np.frombuffer(blob, np.uint32, len(own)).astype(np.uint64)
        low = np.frombuffer(blob, np.uint16, len(own), 4 * len(own))
        parts.append((high << np.uint64(16)) | low)
    hashes = np.concatenate(parts)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    repeated = np.zeros(len(hashes), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    at, out = 0, ([], [])
    for number, own in zip(numbers, refs, strict=True):
        some = own[repeated[at : at + len(own)]]
        at += len(own)
        if len(some):
            out[0].append(number)
            out[1].append(some.tobytes())
    return _marked(out[0], [None] * len(out[0]), out[1])


_BY_DOCUMENT = "key long, hash long, places binary"


def _by_document(keys: np.ndarray, hashes: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.Table:
    """A row per document with its ascending places."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    some, starts = np.unique(doc, return_index=True)
    blobs = [p.astype(np.uint32).tobytes() for p in np.split(place, starts[1:])] if len(some) else []
    columns = [pa.array(keys[some]), pa.array(hashes[some]), pa.array(blobs, pa.binary())]
    return pa.table(columns, ["key", "hash", "places"])


def _anchor_marks(group: pa.Table) -> pa.Table:
    """One batch: the repeated anchors of its documents as word positions."""
    keys, hashes, counts = _read_documents(next(d for d in group["docs"].to_pylist() if d is not None))
    places = [anchor_places(n) for n in counts.tolist()]
    ends = np.cumsum([len(p) for p in places])
    refs = np.concatenate([np.frombuffer(r, np.uint32) for r in group["refs"].to_pylist()])
    refs = np.unique(refs).astype(np.int64)
    all_places = np.concatenate(places) if places else np.zeros(0, np.int64)
    return _by_document(keys, hashes, np.searchsorted(ends, refs, side="right"), all_places[refs])


# -- repeated windows ----------------------------------------------------------------------------


def _candidates(places: np.ndarray, n_words: int) -> np.ndarray:
    """Starts of the windows that hold one of the repeated anchors at ``places``."""
    covered = np.zeros(n_words + 1, np.int64)
    np.add.at(covered, np.maximum(places - PERIOD + 1, 0), 1)
    np.add.at(covered, places + 1, -1)
    return np.flatnonzero(np.cumsum(covered)[: max(n_words - WINDOW + 1, 0)])


def _send_windows(n_buckets: int) -> Callable:
    """Per batch: the first start in the batch of every candidate window, and a row with the
    batch's documents and with the windows that start earlier in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for counter, batch in enumerate(slices(batches, "text")):
            keys, hashes, parts = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("key", "hash", "places", "is_copy")]
            for text, key, own, marks, is_copy in zip(texts(batch, "text"), *columns, strict=True):
                if not marks or is_copy:
                    continue
                words = word_hashes(text.split())
                starts = _candidates(np.frombuffer(marks, np.uint32).astype(np.int64), len(words))
                if not len(starts):
                    continue
                high, low = (_window_hashes(words, WINDOW, f)[starts] for f in _FACTORS[:2])
                doc = np.full(len(starts), len(keys))
                parts.append((high, low, np.full(len(starts), key, np.int64), starts, doc))
                keys.append(key)
                hashes.append(own)
            if not keys:
                continue
            high, low, key, start, doc = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((start, key, low, high))
            high, low, key, start, doc = (a[order] for a in (high, low, key, start, doc))
            first = _first_of_equal(high, low)
            repeat = _after_first(first, key, start)
            number = _batch_number(counter)
            known = _references(doc[repeat], start[repeat])
            rows = [(-1 - number % n_buckets, number, _documents(keys, hashes, keys), None, known)]
            high, low, start, doc = (a[first] for a in (high, low, start, doc))
            all_keys = np.array(keys, np.int64)
            ends = np.searchsorted(_buckets_of(high, n_buckets), np.arange(n_buckets + 1))
            for bucket in np.flatnonzero(np.diff(ends)).tolist():
                own = slice(ends[bucket], ends[bucket + 1])
                some, inside = np.unique(doc[own], return_inverse=True)
                table = np.concatenate((some, all_keys[some])).astype(np.int64).tobytes()
                packed = high[own].tobytes() + low[own].tobytes()
                rows.append((bucket, number, table, packed, _references(inside, start[own])))
            yield _packed(rows)
        release_memory()

    return run


def _references(doc: np.ndarray, start: np.ndarray) -> bytes:
    return doc.astype(np.uint16).tobytes() + start.astype(np.uint32).tobytes()


def _read_references(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // 6
    return np.frombuffer(blob, np.uint16, n), np.frombuffer(blob, np.uint32, n, 2 * n)


def _first_of_equal(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    first = np.ones(len(high), bool)
    first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    return first


def _after_first(first: np.ndarray, key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Of sorted windows, those that start later than the first with the same words."""
    at = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    return (key != key[at]) | (start != start[at])


def _find_repeats(group: pa.Table) -> pa.Table:
    """One bucket: the windows that do not start first among all batches."""
    if group["bucket"][0].as_py() < 0:
        return _passed_on(group)
    numbers = group["batch"].to_pylist()
    parts = []
    for row, (refs, hashes, table) in enumerate(
        zip(*(group[c].to_pylist() for c in ("refs", "hashes", "docs")), strict=True)
    ):
        inside, start = _read_references(refs)
        docs, keys = np.frombuffer(table, np.int64).reshape(2, -1)
        high, low = np.frombuffer(hashes, np.uint64).reshape(2, -1)
        parts.append((high, low, keys[inside], start, docs[inside], np.full(len(start), row)))
    high, low, key, start, doc, row = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((start, key, low, high))
    high, low, key, start, doc, row = (a[order] for a in (high, low, key, start, doc, row))
    repeat = _after_first(_first_of_equal(high, low), key, start)
    start, doc, row = start[repeat], doc[repeat], row[repeat]
    order = np.argsort(row, kind="stable")
    start, doc, row = start[order], doc[order], row[order]
    some, at = np.unique(row, return_index=True)
    blobs = [
        _references(d, s)
        for d, s in zip(np.split(doc, at[1:]), np.split(start, at[1:]), strict=True)
        if len(d)
    ]
    return _marked([numbers[i] for i in some], [None] * len(some), blobs)


def _repeat_marks(group: pa.Table) -> pa.Table:
    """One batch: the starts of its documents' repeated windows."""
    keys, hashes, _ = _read_documents(next(d for d in group["docs"].to_pylist() if d is not None))
    found = [_read_references(r) for r in group["refs"].to_pylist()]
    doc, start = (np.concatenate(c) for c in zip(*found, strict=True))
    return _by_document(keys, hashes, doc.astype(np.int64), start.astype(np.int64))


# -- the operator --------------------------------------------------------------------------------


def covered_words(starts: np.ndarray, n_words: int) -> np.ndarray:
    """True for each word that a window at one of the ``starts`` covers."""
    ends = np.zeros(n_words + 1, np.int64)
    np.add.at(ends, starts, 1)
    np.add.at(ends, starts + WINDOW, -1)
    return np.cumsum(ends)[:n_words] > 0


_RESULT = "text string, n_words long, n_removed long, kept_text string, kept_sha256 string"
_RESULT_NAMES = [field.split()[0] for field in _RESULT.split(", ")]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        n_words, n_removed, kept, digests = [], [], [], []
        marks = zip(batch.column("places").to_pylist(), batch.column("is_copy").to_pylist(), strict=True)
        for text, (places, is_copy) in zip(texts(batch, "text"), marks, strict=True):
            words = text.split()
            left = words
            if is_copy and len(words) >= WINDOW:
                left = []
            elif places and not is_copy:
                gone = covered_words(np.frombuffer(places, np.uint32).astype(np.int64), len(words))
                left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            joined = b" ".join(left)
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(joined)
            digests.append(hashlib.sha256(joined).hexdigest())
        yield pa.record_batch(
            [
                batch.column("row"),
                batch.column("text"),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array(digests, pa.string()),
            ],
            ["row", *_RESULT_NAMES],
        )
    release_memory()


def remove_repeats(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Every document without the words that an earlier passage already has.

    Words are runs of other characters than ASCII white space. A word is removed when it lies in a
    window of ``WINDOW`` words whose sequence also starts earlier: in a document with a smaller
    ``doc_id``, or earlier in the same one. Windows are judged on the input. Returns ``doc_id``,
    ``text``, ``n_words``, ``n_removed``, ``kept_text`` (the kept words joined by single spaces) and
    ``kept_sha256`` (of its UTF-8 bytes, lower-case hexadecimal) after ``doc_id`` and the columns named
    in ``carry``, one row per row of ``docs``.

    Null and empty texts have no words. A null ``doc_id`` comes before all others. Rows that
    repeat a ``doc_id`` count as starting in one document: equal windows at the same place of two such
    rows remove neither, and repeated rows get equal results. Columns other than ``doc_id`` and
    ``text`` are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    carried = [F.col(name).alias(f"_{i}") for i, name in enumerate(carry)]
    rows = docs.select(
        F.struct(doc_id.alias("doc_id"), *carried).alias("row"),
        F.coalesce(doc_id, F.lit(-(2**63))).alias("key"),
        F.xxhash64(text).alias("hash"),
        F.col("text").cast("string").alias("text"),
    )
    slim = rows.select(
        "key",
        "hash",
        F.xxhash64(F.lit(1), F.coalesce("text", F.lit(""))).alias("hash2"),
        F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"),
    )
    slim = materialize(slim, "substring-rows")
    texts_ = slim.groupBy("hash", "hash2").agg(
        F.min("key").alias("first"), F.max("key").alias("last")
    )
    # written, so that Spark can split the join where one text has a large share of the rows
    firsts = materialize(texts_.where("first < last").drop("last"), "substring-firsts")
    copies = slim.join(firsts, ["hash", "hash2"]).where(F.col("key") != F.col("first"))
    copies = copies.select("key", "hash", F.lit(None).cast("binary").alias("places"), F.lit(True).alias("is_copy"))

    n_bytes = slim.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    n_words = n_bytes / _BYTES_PER_WORD
    n_anchors = max(1, round(n_words * len(COVER) / PERIOD / BUCKET_HASHES))
    anchors = rows.select("key", "hash", "text").mapInArrow(_send_anchors(n_anchors), _PACKED)
    repeated = anchors.groupBy("bucket").applyInArrow(_find_repeated, _MARKED)
    marks = repeated.groupBy("batch").applyInArrow(_anchor_marks, _BY_DOCUMENT)
    marks = materialize(marks.withColumn("is_copy", F.lit(False)).unionByName(copies), "substring-marks")

    # dealt out once; both joins below read the same shuffle
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n_parts, "key", "hash")
    marked = dealt.join(_one_each(marks), ["key", "hash"], "left")
    # every column, so that the shuffle is the same as for the other join; sorted, because a document
    # travels as its place in a batch, and a task that is run again must cut the same batches
    windows = marked.select("row", "key", "hash", "text", "places", "is_copy")
    windows = windows.sortWithinPartitions("key", "hash").mapInArrow(
        _send_windows(max(1, round(n_words / BUCKET_HASHES / 4))), _PACKED
    )
    repeats = windows.groupBy("bucket").applyInArrow(_find_repeats, _MARKED)
    repeats = repeats.groupBy("batch").applyInArrow(_repeat_marks, _BY_DOCUMENT)
    gone = _one_each(repeats.withColumn("is_copy", F.lit(False)).unionByName(copies))
    joined = dealt.join(gone, ["key", "hash"], "left")
    joined = joined.select("row", "key", "hash", "text", "places", "is_copy")
    kind = rows.schema["row"].dataType.simpleString()
    found = joined.mapInArrow(_remove, f"row {kind}, {_RESULT}")
    return found.select(
        "row.doc_id",
        *[F.col("row")[f"_{i}"].alias(name) for i, name in enumerate(carry)],
        *_RESULT_NAMES,
    )


def _one_each(marks: DataFrame) -> DataFrame:
    """One row per document; rows that repeat a document have equal marks."""
    return marks.groupBy("key", "hash").agg(
        F.first("places", ignorenulls=True).alias("places"), F.max("is_copy").alias("is_copy")
    )
