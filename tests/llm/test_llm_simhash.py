import random

import pytest
import xxhash
from llm_cases import components, documents, hard_texts, prose
from pyspark.sql import functions as F

from tallyrec.llm.components import connected_components
from tallyrec.llm.simhash import near_pairs, simhash_duplicates


def fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    width = min(3, len(words))
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 2
    ]
    of = components(range(len(rows)), links)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[of[i]] = min(doc, least.get(of[i], doc))
    return [(d, f"{p:016x}", least.get(of[i])) for i, ((d, _), p) in enumerate(zip(rows, prints))]


def check(spark, rows):
    found = simhash_duplicates(spark.createDataFrame(documents(rows))).collect()
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in found]
    assert sorted(got, key=repr) == sorted(expected(rows), key=repr)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found if r.doc_id is not None)


def test_against_brute_force(spark):
    rows = hard_texts()
    for i in range(60):
        words = prose(100 + i % 4, 150).split()
        words[i % 150] = f"new{i}"
        rows.append((100 + i, " ".join(words)))
    check(spark, rows)


def test_empty_table(spark):
    assert simhash_duplicates(spark.createDataFrame(documents([])).limit(0)).count() == 0


def test_pairs_against_brute_force(spark):
    rng = random.Random(5)
    prints = {0, 2**64 - 1}
    for _ in range(30):
        centre = rng.getrandbits(64)
        prints.add(centre)
        for _ in range(12):
            other = centre
            for _ in range(rng.randrange(1, 5)):
                other ^= 1 << rng.randrange(64)
            prints.add(other)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    found = [tuple(r) for r in near_pairs(table).collect()]
    wanted = {
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    }
    assert len(found) == len(set(found))
    assert set(found) == wanted


def test_stamps_are_never_broadcast(spark):
    # a table that Spark knows to be small, before and while it runs
    pairs = near_pairs(spark.range(500).select(F.col("id").alias("fingerprint")))
    assert pairs.count() == sum((a ^ b).bit_count() <= 2 for a in range(500) for b in range(a))
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(8)
    edges = {
        "path": [(i, i + 1) for i in range(200)],
        "star": [(500, i) for i in range(200)] + [(7, 7), (3, 500)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(170)],
        "none": [],
    }[shape]
    rng.shuffle(edges)
    table = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    found = {r.node: r.root for r in connected_components(table).collect()}
    real = [(a, b) for a, b in edges if a != b]
    nodes = {n for e in real for n in e}
    assert found == components(nodes, real)
