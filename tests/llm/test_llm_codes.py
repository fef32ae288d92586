import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from tallyrec.llm.codes import MAX_LENGTHS, compress_vectors, nearest_entries

LONG = np.iinfo(np.int64)


def table(spark, rows):
    names = {"vec_id": pa.int64(), "embedding": pa.list_(pa.float64()), "label": pa.int32()}
    columns = {n: pa.array([r[i] for r in rows], kind) for i, (n, kind) in enumerate(names.items())}
    for clash in ("dim", "vector", "entry", "code", "error", "label_error", "n", "_label"):
        columns[clash] = pa.array(["x"] * len(rows), pa.string())
    return spark.createDataFrame(pa.table(columns))


def whole(x):
    return min(max(math.floor(256 * x), LONG.min), LONG.max) if math.isfinite(256 * x) else (LONG.max if x > 0 else LONG.min)


def expected(rows, n_parts=16, n_entries=64, rounds=2):
    """All distances of all parts, in plain Python; vectors of one length."""
    kept = [
        (i, label, [whole(x) for x in v])
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    dim = len(kept[0][2])
    cuts = [(p * dim // n_parts, (p + 1) * dim // n_parts) for p in range(n_parts)]
    books = [[r[2][a:b] for r in kept[:n_entries]] for a, b in cuts]

    def choose():
        found = []
        for _, _, v in kept:
            best = []
            for (a, b), book in zip(cuts, books):
                best.append(min((sum((x - y) ** 2 for x, y in zip(v[a:b], e)), j) for j, e in enumerate(book)))
            found.append(best)
        return found

    for _ in range(rounds):
        found = choose()
        for p, (a, b) in enumerate(cuts):
            for j in range(len(books[p])):
                own = [r[2][a:b] for r, best in zip(kept, found) if best[p][1] == j]
                if own:
                    books[p][j] = [sum(column) // len(own) for column in zip(*own)]
    found = choose()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in best) for best in found]
    together = {}
    for (_, label, _), error in zip(kept, errors):
        together[label] = together.get(label, 0) + min(error, LONG.max)
    return sorted(
        (
            (i, "".join(f"{j:02x}" for _, j in best), min(e, LONG.max), min(together[label], LONG.max), digest)
            for (i, label, _), best, e in zip(kept, found, errors)
        ),
        key=repr,
    )


def answers(df):
    columns = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


HARD = [
    (3, None, 0),
    (5, [1.0] * 31 + [None], 0),
    (7, [1.0] * 31 + [float("nan")], 1),
    (9, [float("inf")] * 32, 1),
    (11, [0.0] * 32, None),
    (11, [0.0] * 32, None),
    (13, [0.5] * 32, None),
    (13, [-0.5] * 32, 1),
    (None, [0.25] * 32, 1),
]


def random_rows(seed, n, dim=32):
    rng = np.random.default_rng(seed)
    rows = np.round(rng.standard_normal((n, dim)) / 4, 2)
    return [(20 + i, rows[i].tolist(), int(i % 3) if i % 5 else None) for i in range(n)]


@pytest.mark.parametrize("n", [0, 10, 150])
def test_agrees_with_all_distances(spark, n):
    rows = random_rows(2, n) + HARD
    assert answers(compress_vectors(table(spark, rows)).codes) == expected(rows)


def test_does_not_depend_on_partitions(spark):
    rows = random_rows(4, 120)
    df = table(spark, rows)
    assert answers(compress_vectors(df.repartition(7)).codes) == expected(rows)


def test_odd_lengths_and_settings(spark):
    rows = random_rows(6, 70, dim=11)
    found = compress_vectors(table(spark, rows), n_parts=4, n_entries=9, rounds=3)
    assert answers(found.codes) == expected(rows, 4, 9, 3)
    short = [(i, [0.1 * i, 0.2], 0) for i in range(30)]
    both = compress_vectors(table(spark, rows + short + [(500, [], 1)]), n_parts=4, n_entries=9)
    by_dim = {d: answers(both.codes.where(f"dim = {d}")) for d in (11, 2, 0)}
    alone = expected(rows, 4, 9)
    assert [r[:3] for r in by_dim[11]] == [r[:3] for r in alone]
    assert len(by_dim[2]) == 30
    assert by_dim[0][0][1:3] == ("00000000", 0)
    # the codebooks give every vector back up to its error
    books = {(r["entry"], r["part"]): r["components"] for r in both.codebooks.where("dim = 11").collect()}
    originals = {i: [whole(x) for x in v] for i, v, _ in rows}
    for vec_id, code, error, _, _ in by_dim[11]:
        entries = [int(code[2 * p : 2 * p + 2], 16) for p in range(4)]
        decoded = [x for p, e in enumerate(entries) for x in books[e, p]]
        assert sum((x - y) ** 2 for x, y in zip(originals[vec_id], decoded)) == error


def test_large_numbers(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.standard_normal(16) * 10.0 ** rng.integers(0, 14)).tolist(), i % 2) for i in range(90)]
    rows.append((90, [1e300] + [0.0] * 15, 0))
    assert answers(compress_vectors(table(spark, rows)).codes) == expected(rows)


def test_empty_table_and_too_many_lengths(spark):
    df = table(spark, random_rows(9, 3))
    found = compress_vectors(df.limit(0))
    assert found.codes.count() == found.codebooks.count() == 0
    many = table(spark, [(i, [1.0] * i, 0) for i in range(MAX_LENGTHS + 1)])
    with pytest.raises(ValueError, match="lengths"):
        compress_vectors(many)


def test_search_looks_at_few_entries():
    rng = np.random.default_rng(10)
    entries = (256 * rng.standard_normal((64, 4))).astype(np.int64)
    parts = (256 * rng.standard_normal((500, 4))).astype(np.int64)
    code, distance, computed = nearest_entries(parts, entries)
    every = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (code == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert computed < 0.6 * every.size
