import itertools
import zlib

import duckdb
import numpy as np
import pytest
from llm_cases import documents, hard_texts

from tallyrec.llm import language
from tallyrec.llm.language import Model, fit, identify, language_predictions, tagged, viterbi

DOCS = "/root/testdata/sf0.1/documents.parquet"


def best_value(scores, penalty):
    """The highest sum of any labelling."""
    n, k = scores.shape
    return max(
        sum(scores[i, a] for i, a in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))
        for path in itertools.product(range(k), repeat=n)
    )


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(4)
    for _ in range(60):
        lengths = rng.integers(0, 7, rng.integers(1, 6))
        docs = np.concatenate(([0], np.cumsum(lengths)))
        scores = rng.normal(0, 5, (docs[-1], 3))
        labels = viterbi(scores, docs, 6.0)
        for a, b in zip(docs, docs[1:]):
            if a < b:
                own = labels[a:b]
                value = scores[np.arange(a, b), own].sum() - 6.0 * (np.diff(own) != 0).sum()
                assert abs(value - best_value(scores[a:b], 6.0)) < 1e-9


def test_held_out_accuracy(spark):
    found = language_predictions(spark.read.parquet(DOCS)).collect()
    langs = dict(duckdb.sql(f"select doc_id, lang from '{DOCS}'").fetchall())
    held = [r for r in found if r.held_out and langs[r.doc_id]]
    assert len(found) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


TEXTS = {
    "en": "the house is where the weather and the father think that things are there with them",
    "de": "das Haus und die Straße ist nicht weit von der alten Kirche und ich gehe durch die Stadt",
    "ru": "дом стоит на берегу реки и дети играют в саду около старого дома",
    "el": "το σπίτι είναι κοντά στη θάλασσα και τα παιδιά παίζουν στον κήπο",
    "ja": "この家は海の近くにあります そして子供たちは庭で遊びます",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(text, lang) for lang, text in TEXTS.items()] * 3 + [(None, "en"), ("x", None)]
    return fit(spark.createDataFrame(rows, "text string, lang string"))


def test_spans_and_scripts(spark, model):
    mixed = TEXTS["en"] + " " + TEXTS["de"] + " " + TEXTS["ru"]
    rows = [(1, mixed), (2, "дом детей"), (3, "παιδιά"), (4, "家 で"), (5, "חתול")]
    found = {r.doc_id: r for r in identify(spark.createDataFrame(documents(rows)), model, True).collect()}
    assert [s.lang for s in found[1].spans] == ["en", "de", "ru"]
    assert [s.n_words for s in found[1].spans] == [len(TEXTS[lang].split()) for lang in ("en", "de", "ru")]
    assert 0 < found[1].score < 1
    assert [found[i].lang_pred for i in (2, 3, 4)] == ["ru", "el", "ja"]
    assert found[5].lang_pred in TEXTS  # a script that no language has rules none out


def test_hard_rows(spark, model):
    rows = [*hard_texts(), (30, "123 -- !?"), (31, "— … ·"), (32, "x" * 200_000), (33, "1a")]
    df = spark.createDataFrame(documents(rows))
    found = identify(df, model).collect()
    assert len(found) == len(rows)
    none = {3, 4, 5, 30, 31}
    for r in found:
        assert (r.lang_pred == "und" and r.score == 0.0) == (r.doc_id in none)
        assert r.doc_id is not None or not r.held_out
    assert identify(df.limit(0), model).count() == 0
    nothing = language_predictions(df.limit(0).unionByName(df.where("lang is null")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    tags = tagged(df, model, "_l", "_s")
    assert tags.columns == [*df.columns, "_l", "_s"] and tags.count() == len(rows)


def test_model_without_languages(spark):
    empty = Model([], np.zeros((1 << 16, 0)), np.zeros((21, 0)))
    rows = spark.createDataFrame(documents([(1, "some text")]))
    assert [tuple(r)[2:] for r in identify(rows, empty).collect()] == [("und", 0.0)]


@pytest.mark.parametrize("n", [1, 2, 50, 997])
def test_blocks_give_the_labels_of_single_steps(monkeypatch, n):
    rng = np.random.default_rng(n)
    for spread in (1, 6):  # whole numbers, so that there are ties
        scores = np.round(rng.normal(0, spread, (n, 4)))
        ends = np.array([0, n])
        monkeypatch.setattr(language, "BLOCK_WORDS", 1 << 30)
        steps = viterbi(scores, ends, 3.0)
        monkeypatch.setattr(language, "BLOCK_WORDS", 0)
        assert (viterbi(scores, ends, 3.0) == steps).all()


def spans_of(model, text):
    found, shares, runs = language._predict(model, [text, "дом детей"], True)
    return found, shares, runs


@pytest.mark.parametrize("chunk", [61, 400, 5000])
def test_chunks_change_nothing(monkeypatch, model, chunk):
    rng = np.random.default_rng(chunk)
    parts = [TEXTS[lang] for lang in rng.choice(list(TEXTS), 120)]
    unspaced = TEXTS["ja"].replace(" ", "") * 20
    for text in (
        " ".join(parts),
        "".join(parts).replace(" ", ""),  # one word longer than many chunks
        f"{unspaced} 12 {'1' * 900}x{'2' * 900} дом {unspaced}",
        "7" * 6000 + "\n" * 6000,  # no letter at all
        "a" + " " * 6000 + "ß",
    ):
        monkeypatch.setattr(language, "CHUNK_BYTES", 1 << 30)
        whole = spans_of(model, text)
        monkeypatch.setattr(language, "CHUNK_BYTES", chunk)
        assert spans_of(model, text) == whole


def test_megabytes_of_mixed_text(spark, model):
    text = (TEXTS["en"] + " " + TEXTS["ru"] + "\n") * 20_000
    found = identify(spark.createDataFrame(documents([(1, text), (2, TEXTS["de"])])), model, True)
    found = {r.doc_id: r for r in found.collect()}
    assert [s.lang for s in found[1].spans] == ["en", "ru"] * 20_000
    assert found[1].lang_pred == "ru" and found[2].lang_pred == "de"  # letters weigh their bytes
