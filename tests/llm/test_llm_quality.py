import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import documents, hard_texts

from tallyrec.llm import quality
from tallyrec.llm.quality import (
    BUCKETS,
    PASSAGE_WORDS,
    Model,
    describe,
    fit,
    quality_scores,
    score_quality,
    score_texts,
    train,
)


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def corpus(n, seed=1):
    """Sentences of label 1, and shouted, littered or repeated ones of label 0."""
    rng = random.Random(seed)
    syllables = "ka lo mi ne ru sa ti vo wen zor fel dan".split()
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 200))]
        kind = rng.random()
        if kind < 0.1:
            words = [w.upper() + "!!" for w in words]
        elif kind < 0.2:
            words = [w + rng.choice(["###", "$$$", "%%%"]) for w in words]
        elif kind < 0.3:
            words = [w for w in words[::8] for _ in range(8)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind >= 0.3)))
    return rows, labels


def label_table(spark, labels):
    ids, marks = zip(*labels)
    return spark.createDataFrame(
        pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "quality": pa.array(marks, pa.int32()),
                "text": pa.array(["clash"] * len(ids)),
                "score": pa.array([0] * len(ids)),
            }
        )
    )


@pytest.fixture(scope="module")
def fitted():
    rows, labels = corpus(300)
    return train([t.encode() for _, t in rows], np.array([q for _, q in labels]), np.ones(300))


def plain_score(model, text):
    """The score by the formulas, a passage at a time."""
    words = [w for w in text.replace("\n", " ").split(" ") if w]
    passages = [words[i : i + PASSAGE_WORDS] for i in range(0, len(words), PASSAGE_WORDS)]
    if not passages:
        features = [np.zeros(model.weights["E"].shape[0])]
    else:
        whole = " " + " ".join(words) + " "
        features, at = [], 1
        for own in passages:
            end = at + len(" ".join(own)) + 1
            counts = np.zeros(BUCKETS)
            raw = (whole + " ").encode()
            for i in range(at, end):
                code = raw[i - 1] << 16 | raw[i] << 8 | raw[i + 1]
                counts[(code * 0x9E3779B1 % 2**32) >> 21] += 1
            size = end - at
            kinds = [str.isupper, str.islower, str.isdigit, lambda c: not c.isalnum() and c != " ", lambda c: c == "\n"]
            style = [sum(kind(c) for c in whole[at:end]) / size for kind in kinds]
            again = sum(a == b for a, b in zip(own, own[1:]))
            distinct = len(set(own)) / len(own)
            style += [3 * again / len(own), distinct, len(own) / PASSAGE_WORDS, math.log1p(size / len(own)) / 4]
            features.append(np.concatenate((np.sqrt(counts / size), style)))
            at = end
    w = {k: v.astype(float) for k, v in model.weights.items()}
    hidden = [np.tanh(f @ w["E"] + w["e"]) for f in features]
    logits = [float(w["w"] @ (np.tanh(h @ w["V"]) / (1 + np.exp(-(h @ w["U"]))))) for h in hidden]
    shares = np.exp(logits) / np.exp(logits).sum()
    bag = sum(s * h for s, h in zip(shares, hidden))
    return 1 / (1 + math.exp(-(bag @ w["c"] + w["d"][0])))


def test_scores_follow_the_formulas(fitted):
    rows, _ = corpus(12, seed=5)
    some = [t for _, t in rows] + ["", "  ", "one", "", " lead" + " trail" * 90]
    found = score_texts(fitted, [t.encode() for t in some])
    want = [plain_score(fitted, t) for t in some]
    assert np.allclose(found, want, atol=1e-5)
    alone = [score_texts(fitted, [t.encode()])[0] for t in some]
    assert np.allclose(found, alone, atol=1e-6)


def test_gradients_are_those_of_the_loss():
    model = Model()
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    rng = np.random.default_rng(2)
    features = rng.random((9, len(model.weights["E"]))) / 40
    starts, labels, weight = np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    owner = np.repeat([0, 1, 2], [2, 1, 6])

    def loss():
        score = model.score(*model.pooled(quality._Passages(features, owner), 3))
        return -(weight * (labels * np.log(score) + (1 - labels) * np.log(1 - score))).sum() / weight.sum()

    found = model.gradients(features, starts, labels, weight)
    for name, gradient in found.items():
        values = model.weights[name].reshape(-1)
        for i in rng.integers(0, values.size, 5):
            before = values[i]
            values[i] = before + 1e-5
            up = loss()
            values[i] = before - 1e-5
            down = loss()
            values[i] = before
            assert gradient.reshape(-1)[i] == pytest.approx((up - down) / 2e-5, abs=1e-7, rel=1e-4), name


def test_long_texts_are_read_in_pieces(fitted):
    rows, _ = corpus(400, seed=9)
    text = " ".join(t for _, t in rows).encode()
    whole = score_texts(fitted, [text], size=1 << 30)[0]
    in_pieces = score_texts(fitted, [text], size=5000)
    assert in_pieces[0] == pytest.approx(whole, abs=0.02)  # passages end elsewhere
    # neighbours do not matter, nor does an endless word
    others = [b"", b"x" * 30000, text, b"y"]
    assert score_texts(fitted, others, size=5000)[2] == pytest.approx(in_pieces[0], abs=1e-9)
    big = score_texts(fitted, [text * 60])
    assert 0 <= big[0] <= 1


def test_held_out_accuracy(spark):
    rows, labels = corpus(1500, seed=3)
    df = spark.createDataFrame(documents(rows))
    found = {r["doc_id"]: r for r in quality_scores(df, label_table(spark, labels)).collect()}
    assert len(found) == len(rows)
    judged = [(found[i], q) for i, q in labels if held_out(i)]
    assert all(r["held_out"] == held_out(i) for i, r in found.items())
    right = sum(r["predicted"] == q for r, q in judged) / len(judged)
    assert len(judged) > 200 and right > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in found.values())
    # the labels of held-out documents change nothing, nor do null ones
    turned = [(i, 1 - q if held_out(i) else q) for i, q in labels] + [(None, 1), (3, None)]
    again = quality_scores(df, label_table(spark, turned)).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {i: r["score"] for i, r in found.items()}


def test_hard_texts(spark, fitted):
    rows = hard_texts()
    df = spark.createDataFrame(documents(rows))
    found = score_quality(df, fitted)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    got = sorted(((r["doc_id"], r["score"]) for r in found.collect()), key=repr)
    want = score_texts(fitted, [(t or "").encode() for _, t in rows])
    want = sorted(zip((i for i, _ in rows), want), key=repr)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-6)
    assert score_quality(df.limit(0), fitted).count() == 0


def test_labels_that_say_nothing(spark):
    rows, labels = corpus(30, seed=4)
    df = spark.createDataFrame(documents(rows))
    nothing = label_table(spark, [(1, None), (None, 1), (2, 7), (3, 0), (3, 1)])
    scores = [r["score"] for r in quality_scores(df, nothing).collect()]
    assert len(scores) == 30 and all(0 <= s <= 1 for s in scores)
    assert quality_scores(df.limit(0), label_table(spark, labels)).count() == 0
    one = fit(df, label_table(spark, [(i, 1) for i in range(30)]))
    assert score_texts(one, [rows[0][1].encode()])[0] > 0.5


def test_words_and_passages():
    found = describe([b"", b"one two", b"w " * (PASSAGE_WORDS + 1)])
    assert found.texts.tolist() == [0, 1, 2, 2]
    assert not found.features[0].any()
    assert found.features[1][:BUCKETS].any()
