"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words, and only the bag has a label. A passage
is described by the square roots of its byte-trigram shares, hashed, and a few figures of its style.
An encoder turns that into a short vector ``h``; gated attention ``w . (tanh(V h) * sigmoid(U h))``
says how much the passage counts; the softmax-weighted mean of the passages' vectors is scored by a
logistic function. Encoder, attention and score are learned together from document labels.

Scoring goes through the whole text in pieces. The attention of a passage is bounded, so the weighted
sum needs no maximum, and a document of any length leaves one short running sum.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import slices, texts

PASSAGE_WORDS = 64
BUCKETS = 2048  # of hashed byte trigrams
HIDDEN = 24  # numbers that describe a passage after encoding
GATES = 16
UPDATES = 750  # of the weights, in whole passes over the sample
BATCH_DOCS = 64
LEARNING_RATE = 0.004
DECAY = 1e-4
SEED = 1313

# The model is fitted on at most so many documents of either label, of up to so many bytes each.
DOCS_PER_LABEL = 2000
SAMPLE_BYTES = 1 << 15

THRESHOLD = 0.3  # scores from here on are predicted 1
PIECE_BYTES = 1 << 19  # of text read at a time; the arrays made of it take some eighty times that

_BYTE = np.arange(256)
_SPACE = np.isin(_BYTE, [0x20, *range(0x09, 0x0E)])
_UPPER = (_BYTE >= 0x41) & (_BYTE <= 0x5A)
_LOWER = ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80)
_DIGIT = (_BYTE >= 0x30) & (_BYTE <= 0x39)
_SIGN = ~(_SPACE | _UPPER | _LOWER | _DIGIT)
_LINE = _BYTE == 0x0A
_CLASSES = np.stack([_UPPER, _LOWER, _DIGIT, _SIGN, _LINE]).astype(np.float32)
_N_STYLE = 4 + len(_CLASSES)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(1, 65)], np.uint64)


def _pieces(text: bytes, size: int) -> Iterator[bytes]:
    """The text cut behind white space into pieces of about ``size`` bytes; a longer run without
    white space is cut anywhere. Where it is cut depends on the text alone."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while end > at and not _SPACE[text[end - 1]]:
            end -= 1
            if at + size - end > 4096:  # no word: look no further
                end = at
        end = end if end > at else at + size
        yield text[at:end]
        at = end
    yield text[at:]


class _Passages(NamedTuple):
    """Descriptions of passages, and the number of the text that each belongs to."""

    features: np.ndarray
    texts: np.ndarray


def describe(some: list[bytes]) -> _Passages:
    """The passages of some texts; a text without words is one passage of zeros."""
    joined = np.frombuffer(b" " + b"".join(t + b"  " for t in some), np.uint8)
    space = _SPACE[joined]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1  # of words
    lengths = np.array([len(t) + 2 for t in some], np.int64)
    ends = 1 + np.cumsum(lengths)
    first = np.searchsorted(starts, ends - lengths)
    n_words = np.diff(np.append(first, len(starts)))
    n_passages = np.maximum(-(-n_words // PASSAGE_WORDS), 1)
    offset = np.cumsum(n_passages) - n_passages
    of_text = np.repeat(np.arange(len(some)), n_passages)
    n = int(n_passages.sum())
    word_text = np.repeat(np.arange(len(some)), n_words)
    word_passage = offset[word_text] + (np.arange(len(starts)) - first[word_text]) // PASSAGE_WORDS

    features = np.zeros((n, BUCKETS + _N_STYLE), np.float32)
    if len(starts):
        # the bytes of a passage begin with its first word and end before the next passage's, or
        # behind one white space after the text; others go to a passage that is dropped
        is_start = np.zeros(len(joined), bool)
        is_start[starts] = True
        word_of = np.cumsum(is_start[1:-1], dtype=np.int32) - np.int32(1)
        bytes_ = joined[1:-1].astype(np.uint32)
        passage = word_passage[word_of]
        passage[: starts[0] - 1] = n
        passage[ends[:-1] - 2] = n
        lead = np.flatnonzero(space[ends[:-1]])  # texts that begin with white space or have no word
        for text in lead + 1:
            until = starts[first[text]] if n_words[text] else ends[text] - 1
            passage[ends[text - 1] - 1 : until - 1] = n
        code = joined[:-2].astype(np.uint32) << 16 | bytes_ << 8 | joined[2:]
        bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(21)
        shares = np.bincount(passage * BUCKETS + bucket, minlength=(n + 1) * BUCKETS)
        shares = shares[: n * BUCKETS].reshape(n, BUCKETS)
        length = np.maximum(np.bincount(passage, minlength=n + 1)[:n], 1).astype(np.float32)
        features[:, :BUCKETS] = np.sqrt(shares / length[:, None])
        for i, kind in enumerate(_CLASSES):
            features[:, BUCKETS + i] = np.bincount(passage, kind[bytes_], minlength=n + 1)[:n] / length
        # words by a hash: repeats, how many different ones, how many there are, how long they are
        place = np.arange(1, len(joined) - 1) - starts[word_of]
        terms = np.where(space[1:-1], np.uint64(0), bytes_.astype(np.uint64) * _POWERS[place & 63])
        hashes = np.add.reduceat(terms, starts - 1)
        hashes ^= word_passage.astype(np.uint64) << np.uint64(40)
        _, once = np.unique(hashes, return_index=True)
        words = np.maximum(np.bincount(word_passage, minlength=n), 1)
        again = (hashes[1:] == hashes[:-1]).astype(np.float32)  # words that follow themselves
        features[:, -4] = 3 * np.bincount(word_passage[1:], again, minlength=n) / words
        features[:, -3] = np.bincount(word_passage[once], minlength=n) / words
        features[:, -2] = words / PASSAGE_WORDS
        features[:, -1] = np.log1p(length / words) / 4
        features[np.bincount(word_passage, minlength=n) == 0] = 0
    return _Passages(features, of_text)


class Model:
    """The weights of encoder (E, e), attention (V, U, w) and score (c, d)."""

    def __init__(self, rng: np.random.Generator | None = None) -> None:
        rng = rng or np.random.default_rng(SEED)
        width = BUCKETS + _N_STYLE

        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.weights = {
            "E": normal(width, HIDDEN) * np.float32(6),
            "e": np.zeros(HIDDEN, np.float32),
            "V": normal(HIDDEN, GATES),
            "U": normal(HIDDEN, GATES),
            "w": normal(GATES),
            "c": normal(HIDDEN),
            "d": np.zeros(1, np.float32),
        }

    def encode(self, features: np.ndarray) -> np.ndarray:
        return np.tanh(features @ self.weights["E"] + self.weights["e"])

    def attention(self, encoded: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The logit of each passage's attention, and both factors it is made of."""
        turn, gate = np.tanh(encoded @ self.weights["V"]), _logistic(encoded @ self.weights["U"])
        return (turn * gate) @ self.weights["w"], turn, gate

    def pooled(self, passages: _Passages, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Per text, the sum of ``exp(attention)`` and of the passages' vectors weighted by it.

        The logits lie within the sum of ``|w|``, so nothing overflows, and what is known of parts
        of a text can be added up.
        """
        encoded = self.encode(passages.features)
        mass = np.exp(self.attention(encoded)[0].astype(np.float64))
        total = np.bincount(passages.texts, mass, minlength=n_texts)
        weighted = np.stack([np.bincount(passages.texts, mass * h, minlength=n_texts) for h in encoded.T])
        return total, weighted.T

    def score(self, total: np.ndarray, weighted: np.ndarray) -> np.ndarray:
        bag = weighted / total[:, None]
        return _logistic(bag @ self.weights["c"].astype(np.float64) + float(self.weights["d"][0]))

    def gradients(
        self, features: np.ndarray, starts: np.ndarray, labels: np.ndarray, importance: np.ndarray
    ) -> dict[str, np.ndarray]:
        """Of the weighted mean cross entropy of some documents; ``starts`` has their first passage."""
        own = self.weights
        counts = np.diff(np.append(starts, len(features)))
        doc = np.repeat(np.arange(len(starts)), counts)
        encoded = self.encode(features)
        logit, turn, gate = self.attention(encoded)
        mass = np.exp(logit)
        share = mass / np.add.reduceat(mass, starts)[doc]
        bag = np.add.reduceat(share[:, None] * encoded, starts, axis=0)
        error = (_logistic(bag @ own["c"] + own["d"][0]) - labels) * importance / importance.sum()
        to_bag = error[:, None] * own["c"]
        pull = (to_bag[doc] * encoded).sum(axis=1)
        to_logit = share * (pull - np.add.reduceat(share * pull, starts)[doc])
        to_turn = to_logit[:, None] * own["w"] * gate * (1 - turn * turn)
        to_gate = to_logit[:, None] * own["w"] * turn * gate * (1 - gate)
        to_encoded = share[:, None] * to_bag[doc] + to_turn @ own["V"].T + to_gate @ own["U"].T
        inner = to_encoded * (1 - encoded * encoded)
        return {
            "E": features.T @ inner,
            "e": inner.sum(axis=0),
            "V": encoded.T @ to_turn,
            "U": encoded.T @ to_gate,
            "w": (turn * gate).T @ to_logit,
            "c": bag.T @ error,
            "d": error.sum(keepdims=True),
        }


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def train(some: list[bytes], labels: np.ndarray, importance: np.ndarray, updates: int = UPDATES) -> Model:
    """A model of labelled texts, by Adam over small batches in a seeded order."""
    rng = np.random.default_rng(SEED)
    model = Model(rng)
    if not some:
        return model
    labels, importance = labels.astype(np.float32), importance.astype(np.float32)
    described = []
    for at in range(0, len(some), BATCH_DOCS):
        features, owner = describe(some[at : at + BATCH_DOCS])
        cells = np.nonzero(features)
        ends = np.searchsorted(owner, np.arange(len(some[at : at + BATCH_DOCS]) + 1))
        rows = np.searchsorted(cells[0], ends)
        for i, (first, last) in enumerate(zip(ends, ends[1:])):  # kept sparse
            own = slice(rows[i], rows[i + 1])
            row, column = cells[0][own] - first, cells[1][own].astype(np.int16)
            described.append((last - first, row.astype(np.int32), column, features[cells[0][own], cells[1][own]]))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.weights.items()}
    step = 0
    epochs = -(-updates * BATCH_DOCS // len(described))
    for epoch in range(epochs):
        rate = LEARNING_RATE * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(len(described))
        for at in range(0, len(order), BATCH_DOCS):
            chosen = order[at : at + BATCH_DOCS]
            counts = np.array([described[i][0] for i in chosen])
            starts = np.cumsum(counts) - counts
            features = np.zeros((counts.sum(), BUCKETS + _N_STYLE), np.float32)
            for i, start in zip(chosen, starts):
                _, row, column, value = described[i]
                features[start + row, column] = value
            step += 1
            found = model.gradients(features, starts, labels[chosen], importance[chosen])
            for name, gradient in found.items():
                weight, (mean, square) = model.weights[name], moments[name]
                mean += 0.1 * (gradient - mean)
                square += 0.001 * (gradient * gradient - square)
                move = mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
                weight -= (rate * (move + DECAY * weight)).astype(np.float32)
    return model


# -- fitting -------------------------------------------------------------------------------------


def is_held_out(doc_id: Column) -> Column:
    """Documents whose labels no model learns from: a checksum of the id is a multiple of 5."""
    checksum = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(checksum % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, docs_per_label: int = DOCS_PER_LABEL, sample_bytes: int = SAMPLE_BYTES
) -> Model:
    """A model from ``doc_id`` and ``text`` of ``docs`` and ``doc_id`` and ``quality`` of ``labels``.

    The driver learns from a bounded sample: of either label at most ``docs_per_label`` documents of
    up to ``sample_bytes`` bytes, chosen by a hash of the id and the text. Documents weigh as much as
    their label's share of all labels. Held-out documents, null ids, labels but 0 and 1, and ids with
    two different labels are left out. Without a sample the model scores all texts by untrained weights.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(~is_held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    known = known.where(F.col("quality") == F.col("other"))
    totals = dict(known.groupBy("quality").count().collect())
    known = known.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_quality"))
    texts_ = docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where(F.octet_length("text") <= sample_bytes)
    # ids first: only the chosen documents' texts are moved
    chance = F.xxhash64(F.lit(SEED), "_id")
    some, marks = [], []
    for quality in sorted(totals):
        ids = known.where(F.col("_quality") == quality).orderBy(chance, "_id").limit(4 * docs_per_label)
        found = texts_.join(F.broadcast(ids.select("_id")), "_id", "left_semi")
        order = (chance, "_id", F.xxhash64("text"), "text")
        rows = found.orderBy(*order).limit(docs_per_label).select(F.col("text").cast("binary")).collect()
        some += [bytes(row[0]) for row in rows]
        marks += [quality] * len(rows)
    marks = np.array(marks, np.int64)
    weight = np.ones(len(marks))
    for quality in totals:
        weight[marks == quality] = totals[quality] / max((marks == quality).sum(), 1)
    return train(some, marks, weight / max(weight.sum(), 1))


# -- scoring -------------------------------------------------------------------------------------


def score_texts(model: Model, some: list[bytes], size: int = PIECE_BYTES) -> np.ndarray:
    """The score of each text, read in groups of pieces of about ``size`` bytes."""
    total, weighted = np.zeros(len(some)), np.zeros((len(some), HIDDEN))
    group: list[bytes] = []
    owner: list[int] = []

    def flush() -> None:
        if group:
            mass, vectors = model.pooled(describe(group), len(group))
            np.add.at(total, owner, mass)
            np.add.at(weighted, owner, vectors)
            group.clear()
            owner.clear()

    held = 0
    for i, text in enumerate(some):
        for piece in _pieces(text, size):
            if held + len(piece) > size:
                flush()
                held = 0
            group.append(piece)
            owner.append(i)
            held += len(piece)
    flush()
    return model.score(total, weighted) if some else np.zeros(0)


def _scorer(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", size=4 * PIECE_BYTES):
            found = score_texts(model, list(texts(batch, "text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found)],
                ["doc_id", "held_out", "score"],
            )

    return run


def score_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    ``score`` lies between 0 and 1, higher where label 1 is likelier; ``predicted`` is 1 from
    ``threshold`` on, else 0. The text alone decides. A null text is empty, and a text without words
    counts as one passage of zeros. Texts over ``PIECE_BYTES`` are read in pieces, and a passage ends
    where a piece does. Null and repeated ids are kept as they are, other columns are ignored; an
    empty table gives an empty result.
    """
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        is_held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    found = slim.mapInArrow(_scorer(model), "doc_id long, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`score_quality` with a model that is :func:`fit` to the same documents' labels."""
    return score_quality(docs, fit(docs, labels))
