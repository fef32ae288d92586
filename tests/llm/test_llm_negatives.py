import math

import numpy as np
import pyarrow as pa
import pytest

from tallyrec.llm import negatives
from tallyrec.llm.negatives import _Best, _Shard, hard_negatives, threshold_search

LONG = np.iinfo(np.int64)


def table(spark, rows):
    """Rows of id, vector and label, with columns that clash."""
    names = {"vec_id": pa.int64(), "embedding": pa.list_(pa.float64()), "label": pa.int32()}
    columns = {n: pa.array([r[i] for r in rows], kind) for i, (n, kind) in enumerate(names.items())}
    for clash in ("dim", "vector", "shard", "block", "number", "rank", "score", "anchor_id", "n_rows"):
        columns[clash] = pa.array(["x"] * len(rows), pa.string())
    return spark.createDataFrame(pa.table(columns))


def whole(x):
    return min(max(math.floor(256 * x), LONG.min), LONG.max) if math.isfinite(256 * x) else (LONG.max if x > 0 else LONG.min)


def expected(rows, is_anchor, k=5, n=3):
    """Every score of every pair, in plain Python."""
    usable = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((vec_id, label, tuple(whole(x) for x in vector)))
    found = []
    for anchor_id, label, v in set(r for r in usable if r[0] is not None and is_anchor(r[0])):
        scored = []
        for other, its_label, w in usable:
            if other != anchor_id and len(v) == len(w):
                score = min(max(sum(a * b for a, b in zip(v, w)), LONG.min), LONG.max)
                scored.append((-score, other is None, other or 0, other, its_label))
        scored.sort(key=lambda s: s[:3])
        for loss, _, _, positive, _ in [s for s in scored if s[4] == label][:k]:
            hard = [s for s in scored if s[4] != label and 50 * -loss <= 100 * -s[0] <= 95 * -loss]
            for rank, s in enumerate(hard[:n], 1):
                found.append((anchor_id, positive, rank, s[3], -loss, -s[0]))
    return sorted(found, key=repr)


def answers(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


HARD = [
    (900, None, 0),
    (905, [1.0] * 7 + [None], 0),
    (910, [1.0] * 7 + [float("nan")], 1),
    (915, [float("-inf")] * 8, 1),
    (920, [1.0] * 8, None),
    (925, [0.0] * 8, 1),
    (930, [], 1),
    (935, [], 2),
    (940, [1.0, 2.0], 0),
    (945, [0.5, 2.0], 0),
    (946, [0.5, 1.0], 1),
    (950, [0.9] * 8, 0),
    (950, [0.9] * 8, 0),
    (950, [0.7] * 8, 1),
    (951, [0.8] * 8, 0),
    (951, [0.8] * 8, 0),
    (952, [0.6] * 8, 1),
    (952, [0.6] * 8, 1),
    (None, [0.8] * 8, 0),
    (None, [0.6] * 8, 2),
]


def mixed(seed, n, dim=8):
    rng = np.random.default_rng(seed)
    labels = np.where(rng.random(n) < 0.4, 0, rng.integers(0, 6, n))  # one label is frequent
    centres = rng.standard_normal((6, dim))
    rows = centres[labels] * 0.4 + 0.5 * rng.standard_normal((n, dim))
    rows = np.round(rows, 1)  # many ties
    return [(i, rows[i].tolist(), int(labels[i])) for i in range(n)]


@pytest.mark.parametrize("shard_bytes, block_bytes", [(1 << 20, 1 << 20), (64 * 40, 64 * 7)])
def test_agrees_with_all_pairs(spark, shard_bytes, block_bytes):
    rows = mixed(1, 300) + HARD
    df = table(spark, rows)
    found = hard_negatives(
        df, df.where("vec_id % 5 = 0"), shard_bytes=shard_bytes, block_bytes=block_bytes
    )
    assert found.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    ]
    want = expected(rows, lambda i: i % 5 == 0)
    assert len(want) > 300
    assert answers(found) == want


def test_numbers_beyond_doubles(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(4) * 10.0 ** rng.integers(0, 12)).tolist(), i % 2) for i in range(60)]
    rows += [(100, [1e300, 1.0, 0.0, 0.0], 0), (102, [1e300, 1.0, 1.0, 0.0], 0), (101, [1e17, 0.0, 0.0, 1.0], 1)]
    df = table(spark, rows)
    assert answers(hard_negatives(df, df.where("vec_id % 4 = 0"))) == expected(rows, lambda i: i % 4 == 0)


def test_empty_tables(spark):
    rows = mixed(5, 20)
    df = table(spark, rows)
    assert hard_negatives(df.limit(0), df.limit(0)).count() == 0
    assert hard_negatives(df, df.limit(0)).count() == 0
    assert hard_negatives(df.where("label = 0"), df).where("positive_id is not null").count() == 0


def test_search_stops_early():
    """On rows that differ along one direction the threshold ends the search after a few places."""
    rng = np.random.default_rng(7)
    n, dim = 4000, 8
    rows = np.floor(rng.random((n, 1)) * 1000 + rng.random((n, dim))).astype(np.int64)
    shard = _Shard(
        pa.table(
            {
                "vec_id": pa.array(np.arange(n)),
                "label": pa.array(np.zeros(n, np.int64)),
                "dim": pa.array(np.full(n, dim, np.int32)),
                "vector": pa.array(rows.tolist(), pa.list_(pa.int64())),
            }
        )
    )
    anchor = np.full(dim, 3)
    best = _Best(LONG.min, LONG.max, 5)
    scored = threshold_search(shard, anchor, np.ones(n, bool), [best])
    scores = rows @ anchor
    assert scored < n / 10
    assert best.rows.tolist() == np.lexsort((np.arange(n), -scores))[:5].tolist()
    # a window that no row can reach costs nothing
    assert threshold_search(shard, anchor, np.ones(n, bool), [_Best(10**9, 10**9, 5)]) == 0
    assert negatives._FIRST_STEP < n
