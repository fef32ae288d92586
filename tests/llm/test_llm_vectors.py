import math

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import components

from tallyrec.llm.pivots import describe, link_counts, vector_classes, vector_duplicates
from tallyrec.llm.search import top_products


def table(spark, rows):
    """Rows of id, vector and label, with columns that clash."""
    return spark.createDataFrame(
        pa.table(
            {
                "vec_id": pa.array([r[0] for r in rows], pa.int64()),
                "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float64())),
                "label": pa.array([r[2] for r in rows], pa.int32()),
                "dim": pa.array([1] * len(rows), pa.int32()),
                "vector": pa.array(["x"] * len(rows), pa.string()),
                "rank": pa.array([0] * len(rows), pa.int32()),
            }
        )
    )


def clustered(seed, n_groups, size, noise, dim=32):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(n_groups):
        centre = rng.standard_normal(dim)
        for i in range(size):
            v = centre + noise * rng.standard_normal(dim) * rng.random()
            rows.append((g * size + i, v.tolist(), g % 3))
    return rows


HARD = [
    (900, None, 0),
    (901, [], 0),
    (902, [0.0] * 32, 0),
    (903, [1.0] * 31 + [None], 0),
    (904, [1.0] * 31 + [float("nan")], 0),
    (905, [1.0] * 31 + [float("inf")], 0),
    (906, [1.0] * 32, None),
    (907, [1.0] * 32, 0),
    (908, [2.0] * 32, 0),
    (909, [1.0] * 32, 0),
    (909, [1.0] * 32, 0),
    (910, [1.0, 1.0, 1.0], 0),
    (911, [2.0, 2.0, 2.0], 0),
    (912, [1e300] * 32, 0),
    (None, [1.0] * 32, 0),
]


def cosine(a, b):
    a, b = np.array(a) / max(map(abs, a)), np.array(b) / max(map(abs, b))
    return a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_links(rows):
    links = []
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows[:i]):
            if la is not None and la == lb and usable(a) and usable(b) and len(a) == len(b):
                if cosine(a, b) >= 0.93:
                    links.append((i, j))
    return links


def test_duplicates_against_brute_force(spark):
    rows = clustered(1, 20, 12, 0.5) + HARD
    found = vector_duplicates(table(spark, rows)).collect()
    links = brute_links(rows)
    of = components(range(len(rows)), links)
    least = {}
    for i, (vec, _, _) in enumerate(rows):
        if vec is not None:
            least[of[i]] = min(vec, least.get(of[i], vec))
    counts = [sum(i in link for link in links) for i in range(len(rows))]
    wanted = [(v, counts[i], least.get(of[i])) for i, (v, _, _) in enumerate(rows)]
    got = [(r.vec_id, r.n_links, r.component_id) for r in found]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_recall_near_the_threshold(spark):
    # pairs just above the threshold, among vectors that are not alike at all
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        a = rng.standard_normal(64)
        b = rng.standard_normal(64)
        b -= (a @ b) / (a @ a) * a
        turn = math.acos(0.93 + 0.02 * rng.random())
        unit_a, unit_b = a / np.linalg.norm(a), b / np.linalg.norm(b)
        rows += [(2 * i, unit_a.tolist(), 0), (2 * i + 1, (math.cos(turn) * unit_a + math.sin(turn) * unit_b).tolist(), 0)]
    found = vector_duplicates(table(spark, rows)).where("n_links > 0").count()
    assert found / len(rows) >= 0.9


@pytest.mark.parametrize("share", [1 / 3, 0.98])
@pytest.mark.parametrize("spread", ["equal", "mixed"])
def test_recall_in_a_large_group(spark, share, spread):
    # one group of similar vectors holds a third or nearly all of them
    rng, n, dim = np.random.default_rng(4), 1500, 64
    size = int(share * n)
    units = rng.standard_normal((n, dim))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    centre = units[-1]
    inside = units[:size] - np.outer(units[:size] @ centre, centre)
    inside /= np.linalg.norm(inside, axis=1, keepdims=True)
    cosines = np.full((size, 1), math.sqrt(0.935)) if spread == "equal" else 1 - 0.06 * rng.random((size, 1))
    units[:size] = cosines * centre + np.sqrt(1 - cosines**2) * inside
    near = units @ units.T >= 0.93
    np.fill_diagonal(near, False)
    found = vector_duplicates(table(spark, [(i, v.tolist(), 0) for i, v in enumerate(units)]))
    links = sum(r.n_links for r in found.collect())
    assert 0.9 <= links / near.sum() <= 1


def test_blocks_give_the_same_links(spark):
    rows = clustered(5, 3, 60, 0.6)
    described = describe(vector_classes(table(spark, rows)))

    def totals(block):
        links = link_counts(described, block=block)
        return sorted(map(tuple, links.groupBy("class_id").sum("links").collect()))

    assert totals(7) == totals(10_000)


def test_no_vectors(spark):
    empty = table(spark, HARD).limit(0)
    assert vector_duplicates(empty).count() == 0
    assert top_products(empty, empty).count() == 0


def whole(v):
    return [min(max(math.floor(64 * x), -(2**63)), 2**63 - 1) for x in v]


def brute_top(rows, queries, k):
    fine = [(i, whole(v)) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {(i, tuple(v)) for i, v in fine if i in queries}
    out = []
    for i, q in asked:
        scored = [
            (min(max(sum(a * b for a, b in zip(q, v)), -(2**63)), 2**63 - 1), j)
            for j, v in fine
            if j != i and len(v) == len(q)
        ]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1]))
        out += [(i, n, j, s) for n, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def test_top_products_against_brute_force(spark):
    rows = clustered(9, 6, 30, 0.3) + HARD + [(1000 + i, [float(i % 3)] * 32, 0) for i in range(40)]
    rows += [(2000 + i, [1.0, 2.0, float(i)], 0) for i in range(5)]
    df = table(spark, rows)
    queries = {r[0] for r in rows if r[0] is not None and r[0] % 20 == 0} | {909, 912, 910, 901}
    asked = df.where(df.vec_id.isin(sorted(queries)))
    wanted = brute_top(rows, queries, 20)
    for sizes in ({}, {"query_rows": 4, "shard_rows": 16, "fan_in": 2}):
        found = top_products(df, asked, **sizes)
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, found.collect()), key=repr) == wanted


def test_huge_components_stay_exact(spark):
    rows = [(i, [2.0**40 + i, 3.0], 0) for i in range(30)]
    df = table(spark, rows)
    wanted = brute_top(rows, {0, 20}, 20)
    found = top_products(df, df.where("vec_id % 20 = 0"))
    assert sorted(map(tuple, found.collect()), key=repr) == wanted
