"""Language identification of spans by script ranges, per-word scores and Viterbi.

A model holds, for each language, the log probabilities of hashed byte trigrams and the scripts its
letters come from. The scripts of a word narrow the languages it may be in; the trigrams around its
letters score it in each. Viterbi then labels a document's words so that the sum of the scores
is highest, where each change of language costs a penalty, which yields spans. The document's
language is the one whose spans have the most letters.

Everything is computed for a slice of documents at a time in whole arrays. Documents in which no
stretch of words could pay for a change have one span and skip the step-by-step search. The search
goes through the words of a long document in blocks side by side, joined by max-plus products. A very
long text is scored and searched in chunks that hand on the state: forwards for the values at the cuts,
then backwards for the labels. Scores are multiples of 2**-16, so sums are exact and the labels do not
depend on how words are grouped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrec.llm.batches import release_memory, slices, texts

DOCS_PER_LANGUAGE = 2000  # the model is fitted on about so many documents of a language at most
PENALTY = 12.0  # nats for a change of language between two words
SMOOTHING = 0.2
SCRIPT_SHARE = 0.01  # of a language's letters that make a script one of its own
SLICE_BYTES = 1 << 20  # of texts at a time; the arrays made of them take some thirty times that
CHUNK_BYTES = 1 << 20  # longer texts are scored and searched in chunks of so many bytes
BLOCK_WORDS = 4096  # documents of more words are searched in blocks
SEED = 909
UNKNOWN = "und"

_BUCKETS = 1 << 16
_OUT_OF_SCRIPT = -50.0
_GRAIN = 2.0**-16

# First and last code points of scripts, as Unicode lays out its blocks.
SCRIPTS = {
    "Latin": [(0x0041, 0x024F), (0x1E00, 0x1EFF)],
    "Greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x0400, 0x052F)],
    "Armenian": [(0x0530, 0x058F)],
    "Hebrew": [(0x0590, 0x05FF)],
    "Arabic": [(0x0600, 0x06FF), (0x0750, 0x077F)],
    "Devanagari": [(0x0900, 0x097F)],
    "Bengali": [(0x0980, 0x09FF)],
    "Gurmukhi": [(0x0A00, 0x0A7F)],
    "Gujarati": [(0x0A80, 0x0AFF)],
    "Tamil": [(0x0B80, 0x0BFF)],
    "Telugu": [(0x0C00, 0x0C7F)],
    "Kannada": [(0x0C80, 0x0CFF)],
    "Malayalam": [(0x0D00, 0x0D7F)],
    "Thai": [(0x0E00, 0x0E7F)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Ethiopic": [(0x1200, 0x137F)],
    "Khmer": [(0x1780, 0x17FF)],
    "Kana": [(0x3040, 0x30FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FFFF)],
    "Hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
}

_LETTER = regex.compile(r"\p{L}")


def _script_table() -> np.ndarray:
    """The script bit by the first two bytes of a character. A pair of lead bytes stands for 64
    code points or more, and no script begins inside."""
    table = np.zeros(1 << 16, np.uint32)
    for first in range(0x41, 0xF5):
        for second in range(256):
            if first < 0x80:
                point = first
            elif 0xC2 <= first < 0xE0:
                point = (first & 0x1F) << 6 | 0x3F
            elif 0xE0 <= first < 0xF0:
                point = (first & 0x0F) << 12 | (second & 0x3F) << 6 | 0x20
            elif first >= 0xF0:
                point = (first & 0x07) << 18 | (second & 0x3F) << 12 | 0x800
            else:
                continue
            for bit, ranges in enumerate(SCRIPTS.values()):
                if any(low <= point <= high for low, high in ranges):
                    table[first << 8 | second] = 1 << bit
    return table


_SCRIPT_OF = _script_table()
_BYTE = np.arange(256)
_IS_SPACE = np.isin(_BYTE, [0x20, *range(0x09, 0x0E)])
_IS_LETTER = (_BYTE >= 0x80) | ((_BYTE | 0x20 >= 0x61) & (_BYTE | 0x20 <= 0x7A) & (_BYTE >= 0x41))


class _Words:
    """The words with letters of some texts: where they are, their trigrams and scripts.

    ``parts`` are lower-cased texts, or one piece of a text with the byte ``before`` it and the two
    ``after`` it.
    """

    def __init__(self, parts: list[bytes], before: bytes = b" ", after: bytes = b"  ") -> None:
        joined = np.frombuffer(before + b" ".join(parts) + after, np.uint8)
        space = _IS_SPACE[joined]
        joined = np.where(space, np.uint8(0x20), joined)
        self.letters = 1 + np.flatnonzero(_IS_LETTER[joined[1:-2]])
        at = self.letters
        self.spaces = int(space[:-2].sum())
        middle = joined[at].astype(np.uint32)
        after = joined[at + 1].astype(np.uint32)
        code = joined[at - 1].astype(np.uint32) << 16 | middle << 8 | after
        self.trigrams = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
        self.script_bits = _SCRIPT_OF[middle << 8 | after]
        number = np.cumsum(space)[at]
        self.starts = np.flatnonzero(np.diff(number, prepend=-1))  # of words, among the letters
        self.word = number  # white space before a word, for its place in the text
        ends = 1 + np.cumsum([len(p) + 1 for p in parts])
        begins = np.concatenate(([0], ends)) if len(parts) else np.zeros(1, np.int64)
        first_letter = at[self.starts] if len(at) else at
        self.docs = np.searchsorted(first_letter, begins)  # first word of each document, and the end

    def sum(self, values: np.ndarray) -> np.ndarray:
        """Per word, the sum of what its letters have."""
        if not len(self.starts):
            return values[:0]
        return np.add.reduceat(values, self.starts, axis=0)

    def scripts(self) -> np.ndarray:
        if not len(self.starts):
            return self.script_bits[:0]
        return np.bitwise_or.reduceat(self.script_bits, self.starts)


class Model:
    """Weights of trigrams and scripts of the languages, in the order of their names."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray) -> None:
        self.languages = languages
        smooth = counts + SMOOTHING
        self.weights = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=0), 1)
        bits = np.uint32(1) << np.arange(len(SCRIPTS), dtype=np.uint32)
        self.masks = np.array([bits[own >= SCRIPT_SHARE].sum() for own in share.T], np.uint32)

    def scores(self, words: _Words) -> np.ndarray:
        """Per word and language."""
        return self.ruled(words.sum(self.weights[words.trigrams]), words.scripts())

    def ruled(self, sums: np.ndarray, scripts: np.ndarray) -> np.ndarray:
        """A language without the word's scripts is ruled out, unless no language has them."""
        inside = (scripts[:, None] & ~self.masks[None, :]) == 0
        out = ~inside & inside.any(axis=1)[:, None]
        scores = np.where(out, sums + sums.dtype.type(_OUT_OF_SCRIPT), sums).astype(np.float64)
        return np.round(scores / _GRAIN) * _GRAIN


def viterbi(scores: np.ndarray, docs: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """A language number for every word; ``docs`` has the first word of each document and the end.

    Among equal paths the one that stays, and then the lower number, is taken.
    """
    labels = np.zeros(len(scores), np.int64)
    lengths = np.diff(docs)
    some = np.flatnonzero(lengths)
    if not len(some):
        return labels
    starts = docs[some]
    best = np.add.reduceat(scores, starts, axis=0).argmax(axis=1)
    of_word = np.repeat(np.arange(len(some)), lengths[some])
    labels[:] = best[of_word]
    # the most that any stretch of words could gain in another language
    gains = scores - scores[np.arange(len(scores)), labels][:, None]
    before = np.cumsum(gains, axis=0) - gains
    apart = (np.abs(gains).sum() + 1) * of_word[:, None]
    lowest = np.minimum.accumulate(before - apart, axis=0) + apart
    most = np.maximum.reduceat((before + gains - lowest).max(axis=1), starts)
    mixed = np.flatnonzero(most > penalty / 2)
    starts, lengths = starts[mixed], lengths[some][mixed]
    long = lengths > BLOCK_WORDS
    for start, n in zip(starts[long], lengths[long], strict=True):
        own = scores[start : start + n]
        labels[start : start + n] = _trace(own, np.zeros(own.shape[1]), penalty)[0]
    if not long.all():
        _search(scores, starts[~long], lengths[~long], penalty, labels)
    return labels


def _search(
    scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, penalty: float, labels: np.ndarray
) -> None:
    """Label the words of some documents, a word of each at a time."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    value = scores[starts].copy()
    came = np.zeros(scores.shape, np.int16)
    own = np.arange(scores.shape[1], dtype=np.int16)
    alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    for t in range(1, lengths[0]):
        n = alive[t]
        top = value[:n].argmax(axis=1)
        moved = value[np.arange(n), top][:, None] - penalty
        stays = value[:n] >= moved
        came[starts[:n] + t] = np.where(stays, own, top[:, None])
        value[:n] = np.where(stays, value[:n], moved) + scores[starts[:n] + t]
    label = value.argmax(axis=1)
    for t in range(lengths[0] - 1, -1, -1):
        n = alive[t]
        labels[starts[:n] + t] = label[:n]
        if t:
            label[:n] = came[starts[:n] + t, label[:n]]


def _step(value: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values before a word's own scores, who stays, and whom the others come from."""
    top = value.argmax(axis=-1)[..., None]
    moved = np.take_along_axis(value, top, axis=-1) - penalty
    stays = value >= moved
    return np.where(stays, value, moved), stays, top


def _blocked(scores: np.ndarray) -> np.ndarray:
    """The words of a document as steps x blocks x languages. Words without any score fill the last
    block up; they change nothing, as a value never falls further behind than a change costs."""
    n, k = scores.shape
    steps = max(1, int(n**0.5))
    blocks = -(-n // steps)
    full = np.zeros((steps * blocks, k))
    full[:n] = scores
    return np.ascontiguousarray(full.reshape(blocks, steps, k).transpose(1, 0, 2))


def _values(blocked: np.ndarray, start: np.ndarray, penalty: float) -> np.ndarray:
    """The value of every language before each block, and after the last: blocks' products in turn."""
    _, blocks, k = blocked.shape
    product = np.where(np.eye(k, dtype=bool), 0.0, -np.inf)
    product = np.broadcast_to(product, (blocks, k, k))  # from a language, into a language
    for own in blocked:
        moved = product.max(axis=-1)[..., None] - penalty
        product = np.maximum(product, moved) + own[:, None, :]
    values = np.empty((blocks + 1, k))
    values[0] = start
    for b in range(blocks):
        values[b + 1] = (values[b][:, None] + product[b]).max(axis=0)
    return values


def _trace(
    scores: np.ndarray, start: np.ndarray, penalty: float, label: int | None = None
) -> tuple[np.ndarray, int]:
    """The labels of successive words, and the label before them.

    ``start`` has the languages' values before the first word, ``label`` the last word's label where
    later words have decided it.
    """
    n, k = scores.shape
    blocked = _blocked(scores)
    steps, blocks, _ = blocked.shape
    values = _values(blocked, start, penalty)
    came = np.empty((steps, blocks, k), np.int16)
    own = np.arange(k, dtype=np.int16)
    value = values[:-1]
    for t in range(steps):
        value, stays, top = _step(value, penalty)
        came[t] = np.where(stays, own, top)
        value = value + blocked[t]
    before = np.broadcast_to(own, (blocks, k))  # a block's last label gives the label before it
    for t in range(steps - 1, -1, -1):
        before = np.take_along_axis(came[t], before.astype(np.int64), axis=1)
    ends = np.empty(blocks, np.int64)
    last = int(values[-1].argmax()) if label is None else label
    for b in range(blocks - 1, -1, -1):
        ends[b] = last
        last = int(before[b, last])
    labels = np.empty((blocks, steps), np.int64)
    at = np.arange(blocks)
    for t in range(steps - 1, -1, -1):
        labels[:, t] = ends
        ends = came[t, at, ends]
    return labels.reshape(-1)[:n], last


# -- very long texts -----------------------------------------------------------------------------

# the sums, scripts and letters of a word that goes on in the next chunk
_Open = tuple[np.ndarray, np.uint32, int]


def _cuts(text: bytes) -> Iterator[tuple[int, int]]:
    """Chunks of a text, cut after white space where there is any."""
    low = 0
    while low < len(text):
        high = min(low + CHUNK_BYTES, len(text))
        if high < len(text):
            spaces = np.flatnonzero(_IS_SPACE[np.frombuffer(text, np.uint8, high - low, low)])
            high = low + int(spaces[-1]) + 1 if len(spaces) else high
        yield low, high
        low = high


def _chunk(
    model: Model, text: bytes, low: int, high: int, open_word: _Open | None
) -> tuple[np.ndarray, np.ndarray, _Open | None]:
    """Scores and letters of the words that end in a chunk, and the word that goes on behind it."""
    before, after = text[low - 1 : low] if low else b" ", (text[high : high + 2] + b"  ")[:2]
    words = _Words([text[low:high]], before, after)
    sums, scripts = words.sum(model.weights[words.trigrams]), words.scripts()
    letters = np.diff(words.starts, append=len(words.letters))
    goes_on = words.word[words.starts[-1]] == words.spaces if len(words.starts) else not words.spaces
    goes_on = goes_on and high < len(text)
    if open_word is not None:
        sums = np.concatenate((open_word[0][None], sums))
        scripts = np.concatenate((np.array([open_word[1]], np.uint32), scripts))
        letters = np.concatenate(([open_word[2]], letters))
        if len(words.starts) and words.word[0] == 0:  # the first word here is the same word
            sums[1] += sums[0]
            scripts[1] |= scripts[0]
            letters[1] += letters[0]
            sums, scripts, letters = sums[1:], scripts[1:], letters[1:]
    open_word = None
    if goes_on and len(sums):
        open_word = sums[-1].astype(np.float64), scripts[-1], int(letters[-1])
        sums, scripts, letters = sums[:-1], scripts[:-1], letters[:-1]
    return model.ruled(sums, scripts), letters, open_word


def label_long(
    model: Model, text: str, penalty: float = PENALTY
) -> tuple[np.ndarray, np.ndarray]:
    """The labels of a text's words, and the letters in each language, in bounded memory beside the
    text and a small number per word. The labels are those that :func:`viterbi` gives."""
    low_case = text.lower().encode()
    value, open_word = np.zeros(len(model.languages)), None
    states = []
    for low, high in _cuts(low_case):
        states.append((low, high, value, open_word))
        scores, _, open_word = _chunk(model, low_case, low, high, open_word)
        if len(scores):
            value = _values(_blocked(scores), value, penalty)[-1]
    label, found = None, []
    held = np.zeros(len(model.languages), np.int64)
    for low, high, value, open_word in reversed(states):
        scores, letters, _ = _chunk(model, low_case, low, high, open_word)
        if len(scores):
            labels, label = _trace(scores, value, penalty, label)
            held += np.bincount(labels, letters, len(held)).astype(np.int64)
            found.append(labels.astype(np.int16))
    return np.concatenate([np.zeros(0, np.int16), *reversed(found)]), held


# -- fitting -------------------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found: dict[str, list[str]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), texts(batch, "text"), strict=True):
            found.setdefault(lang, []).append(text.decode())
        for lang, some in found.items():
            words = _Words([text.lower().encode() for text in some])
            counts = np.bincount(words.trigrams, minlength=_BUCKETS)
            bits = [(words.script_bits >> b & 1).sum() for b in range(len(SCRIPTS))]
            counts = np.concatenate((counts, np.array(bits, np.int64)))
            buckets = np.flatnonzero(counts)
            yield pa.record_batch(
                [
                    pa.array([lang] * len(buckets), pa.string()),
                    pa.array(buckets.astype(np.int32)),
                    pa.array(counts[buckets].astype(np.int64)),
                ],
                ["lang", "bucket", "n"],
            )
    release_memory()


def fit(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """A model from ``text`` and ``lang``; null languages and texts are left out.

    About ``docs_per_language`` documents of each language are used, chosen by a hash of the text;
    fewer languages than one give a model that knows none. The driver gets a figure per language
    and trigram bucket.
    """
    known = labelled.where("lang is not null and text is not null").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    totals = dict(known.groupBy("lang").count().collect())
    languages = sorted(totals)
    counts = np.zeros((_BUCKETS + len(SCRIPTS), len(languages)))
    if languages:
        share = F.lit(0.0)
        for lang, n in totals.items():
            share = F.when(F.col("lang") == lang, min(1.0, docs_per_language / n)).otherwise(share)
        even = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "text"), 11) / F.lit(float(1 << 53))
        sample = known.where(even < share)
        sums = sample.mapInArrow(_count, "lang string, bucket int, n long")
        sums = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
        column = sums["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(np.int64)
        counts[sums["bucket"].to_numpy(), column] = sums["n"].to_numpy()
    return Model(languages, counts[:_BUCKETS], counts[_BUCKETS:])


# -- prediction ----------------------------------------------------------------------------------

_SPANS = "array<struct<first_word:int,n_words:int,lang:string>>"


def _predictor(
    model: Model, spans: bool, lang: str = "lang_pred", score: str = "score"
) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", size=SLICE_BYTES):
            some = [t.decode() for t in texts(batch, "text")]
            found, scores, runs = _predict(model, some, spans)
            columns = [*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            names = [*batch.schema.names, lang, score]
            if spans:
                kind = pa.struct(
                    [("first_word", pa.int32()), ("n_words", pa.int32()), ("lang", pa.string())]
                )
                columns.append(pa.array(runs, pa.list_(kind)))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names)
        release_memory()

    return run


def _is_long(text: str) -> bool:
    return len(text) > CHUNK_BYTES


def _predict(model: Model, some: list[str], spans: bool) -> tuple[list, list, list]:
    found, shares, runs = [UNKNOWN] * len(some), [0.0] * len(some), [[] for _ in some]
    if not model.languages:
        return found, shares, runs
    lower = [b"" if _is_long(text) else text.lower().encode() for text in some]
    words = _Words(lower)
    labels = viterbi(model.scores(words), words.docs)
    letters = np.diff(words.starts, append=len(words.letters))
    of_doc = np.repeat(np.arange(len(some)), np.diff(words.docs))
    held = np.zeros((len(some), len(model.languages)))
    np.add.at(held, (of_doc, labels), letters)
    own = {}
    for i, text in enumerate(some):
        if _is_long(text):
            own[i], held[i] = label_long(model, text)
    best = held.argmax(axis=1)
    for i, text in enumerate(some):
        if _LETTER.search(text):
            found[i] = model.languages[best[i]]
            shares[i] = held[i, best[i]] / held[i].sum()
            if spans:
                of_text = own.get(i, labels[words.docs[i] : words.docs[i + 1]])
                runs[i] = _runs(of_text, model.languages)
    return found, shares, runs


def _runs(labels: np.ndarray, languages: list[str]) -> list[dict]:
    starts = np.flatnonzero(np.diff(labels, prepend=-1))
    lengths = np.diff(starts, append=len(labels))
    return [
        {"first_word": int(s), "n_words": int(n), "lang": languages[labels[s]]}
        for s, n in zip(starts, lengths, strict=True)
    ]


def is_held_out(doc_id: Column) -> Column:
    """Documents that no model learns from: a checksum of the id leaves 1 when divided by 3."""
    checksum = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(checksum % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row of ``docs``.

    ``score`` is the share of the document's letters in spans of the predicted language.
    A null text, an empty one, one without letters, or any text under a model without languages is
    ``und`` with score 0. Equal evidence goes to the language that comes first by name. With
    ``spans`` there is a column of spans, counted in words that have letters. A text of more than
    ``CHUNK_BYTES`` characters is labelled whole, chunk by chunk. Null and repeated ids are kept as
    they are, other columns are ignored; an empty table gives an empty result.
    """
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        is_held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    schema = "doc_id long, held_out boolean, text string, lang_pred string, score double"
    schema += f", spans {_SPANS}" if spans else ""
    return slim.mapInArrow(_predictor(model, spans), schema).drop("text")


def tagged(docs: DataFrame, model: Model, lang: str, score: str) -> DataFrame:
    """``docs`` with two more columns, named ``lang`` and ``score``: what :func:`identify` finds."""
    more = [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    kind = T.StructType([*docs.schema.fields, *more])
    return docs.mapInArrow(_predictor(model, False, lang, score), kind)


def own_model(docs: DataFrame) -> Model:
    """A model of the documents of ``docs`` that are not held out."""
    learned = docs.where(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    return fit(learned.select("lang", "text"))


def language_predictions(docs: DataFrame, spans: bool = False) -> DataFrame:
    """:func:`identify` with the documents' :func:`own_model`."""
    return identify(docs, own_model(docs), spans)
