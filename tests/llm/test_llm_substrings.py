import hashlib
import random

import duckdb
import numpy as np
import pytest
from llm_cases import documents, hard_texts, prose

from tallyrec.llm import substrings
from tallyrec.llm.substrings import COVER, PERIOD, WINDOW, anchor_places, remove_repeats


def brute(rows):
    """Words kept per row, by a table of all windows."""
    first = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - WINDOW + 1):
            key = tuple(words[i : i + WINDOW])
            place = (doc is not None, doc or 0, i)
            first[key] = min(first.get(key, place), place)
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - WINDOW + 1):
            if first[tuple(words[i : i + WINDOW])] < (doc is not None, doc or 0, i):
                gone[i : i + WINDOW] = [True] * WINDOW
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    df = remove_repeats(spark.createDataFrame(documents(rows)), ("lang", "key"))
    assert df.columns[:3] == ["doc_id", "lang", "key"]
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr
    )


def test_cover():
    pairs = {(a - b) % PERIOD for a in COVER for b in COVER}
    assert pairs == set(range(PERIOD)) and PERIOD <= WINDOW
    for n in range(60):
        places = anchor_places(n)
        for i in range(n - WINDOW + 1):
            assert {p % PERIOD for p in places if i <= p <= i + PERIOD - 1} == set(COVER)


def test_hard_rows(spark):
    assert found(spark, hard_texts()) == brute(hard_texts())
    assert remove_repeats(spark.createDataFrame(documents([])).limit(0)).count() == 0


@pytest.mark.parametrize("slice_rows", [4096, 3])
def test_random_repeats(spark, slice_rows, monkeypatch):
    rng = random.Random(11)
    pool = [prose(1000 + i, rng.randrange(15, 70)) for i in range(12)]
    rows = []
    for i in range(120):
        parts = [prose(2000 + i, rng.randrange(0, 30)) for _ in range(2)]
        parts += rng.sample(pool, rng.randrange(0, 3))
        rng.shuffle(parts)
        rows.append((rng.randrange(10_000), " ".join(parts)))
    rows = list({d: (d, t) for d, t in rows}.values())
    rows += [(20_000 + i, rows[0][1]) for i in range(5)]
    if slice_rows != 4096:
        # small batches inside this process
        check_batches(rows, slice_rows)
    else:
        assert found(spark, rows) == brute(rows)


def check_batches(rows, size):
    """The stages on a few documents a time, without Spark."""
    import pyarrow as pa

    def batch(some, **more):
        base = {
            "key": pa.array([d for d, _ in some], pa.int64()),
            "hash": pa.array([hash(t) for _, t in some], pa.int64()),
            "text": pa.array([t for _, t in some], pa.string()),
        }
        return pa.RecordBatch.from_pydict({**base, **more})

    def grouped(table, name):
        return [table.filter(pa.compute.equal(table[name], v)) for v in pa.compute.unique(table[name])]

    def joined(send, settle, mark, batches):
        sent = pa.Table.from_batches(list(send(iter(batches))))
        settled = pa.concat_tables([settle(g) for g in grouped(sent, "bucket")])
        marks = pa.concat_tables([mark(g) for g in grouped(settled, "batch")])
        return {k: p for k, p in zip(marks["key"].to_pylist(), marks["places"].to_pylist())}

    chunks = [rows[i : i + size] for i in range(0, len(rows), size)]
    one = substrings._send_anchors(7)
    anchors = joined(
        lambda bs: (b for i, x in enumerate(bs) for b in _numbered(one, x, i)),
        substrings._find_repeated,
        substrings._anchor_marks,
        [batch(c) for c in chunks],
    )
    two = substrings._send_windows(5)
    marked = [
        batch(
            c,
            places=pa.array([anchors.get(d) for d, _ in c], pa.binary()),
            is_copy=pa.array([None] * len(c), pa.bool_()),
        )
        for c in chunks
    ]
    repeats = joined(
        lambda bs: (b for i, x in enumerate(bs) for b in _numbered(two, x, i)),
        substrings._find_repeats,
        substrings._repeat_marks,
        marked,
    )
    for doc, n_words, n_removed, _ in brute(rows):
        places = np.frombuffer(repeats.get(doc, b""), np.uint32).astype(np.int64)
        assert substrings.covered_words(places, n_words).sum() == n_removed


def _numbered(send, batch, number):
    """The rows of one batch, under a number of its own."""
    for out in send(iter([batch])):
        i = out.schema.get_field_index("batch")
        import pyarrow as pa

        yield out.set_column(i, "batch", pa.array([number] * out.num_rows, pa.int64()))


def test_given_documents(spark):
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    assert found(spark, rows) == brute(rows)
