import numpy as np
from llm_cases import documents, hard_texts, prose

from tallyrec.llm.mixing import mix_sources, mixed_documents, split_quotas, targets, write_mix


def level_targets(sizes):
    """The same shares by bisection on the level of the unlimited sources."""
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    low, high = 0.0, 2.0 * sum(sizes) + 1
    for _ in range(200):
        level = (low + high) / 2
        total = sum(min(w * level, 2 * s) for w, s in zip(weights, sizes))
        low, high = (level, high) if total < 1.5 * sum(sizes) else (low, level)
    return [min(w * high, 2 * s) for w, s in zip(weights, sizes)]


def test_targets():
    rng = np.random.default_rng(2)
    for sizes in ([], [0], [0, 0, 0], [10], [100, 1, 1], [5, 0, 7, 300, 2, 40, 900]):
        assert np.allclose(targets(sizes), level_targets(sizes), atol=1e-6)
    for _ in range(50):
        sizes = rng.integers(0, 1000, rng.integers(1, 12)).tolist()
        assert np.allclose(targets(sizes), level_targets(sizes), rtol=1e-9, atol=1e-6)


def test_splitting_tree():
    quotas = [500, 3, 0, 77, 1200]
    for n_shards in (1, 2, 7, 24):
        out = split_quotas(quotas, n_shards)
        assert out.sum(axis=1).tolist() == quotas and (out >= 0).all()
        assert np.ptp(out.sum(axis=0)) <= max(1, np.ceil(np.log2(n_shards)))
    many = np.array([split_quotas([300, 100], 2, seed)[0, 0] for seed in range(400)])
    # hypergeometric: mean 150, variance 200 * .75 * .25 * 200 / 399
    assert abs(many.mean() - 150) < 1 and 14 < many.var() < 24


def table(spark, rows, sources):
    import pyarrow as pa

    return spark.createDataFrame(documents(rows, source=pa.array(sources, pa.string())))


def test_mix(spark):
    rows = hard_texts() + [(100 + i, prose(i, 3 + i % 40)) for i in range(300)]
    sources = [("hot" if i % 3 else [None, "a", "B", "é", "z"][i % 5]) for i in range(len(rows))]
    found = mix_sources(table(spark, rows, sources), n_blocks=97).collect()
    words = [len((t or "").encode().split()) for _, t in rows]
    totals = {}
    for s, n in zip(sources, words):
        totals[s] = totals.get(s, 0) + n
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(order, targets([totals[s] for s in order])))
    assert sorted(r.size for r in found) == sorted(words)
    taken = {}
    shards = {}
    for r in found:
        assert r.source_size == totals[r.source] and abs(r.target - wanted[r.source]) < 1e-6
        own = sum(p.n_words for p in r.pieces)
        assert own <= 2 * r.size
        for copy in (0, 1):
            spans = sorted((p.first_word, p.n_words) for p in r.pieces if p.copy == copy)
            assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
        taken[r.source] = taken.get(r.source, 0) + own
        for p in r.pieces:
            shards.setdefault(p.shard, set()).add((r.source, p.block))
    assert all(abs(taken[s] - wanted[s]) <= 1 for s in order)
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 5
    # a block is in one shard only
    assert sum(map(len, shards.values())) == len(set().union(*shards.values()))


def test_mix_again_is_the_same(spark):
    rows = [(i, prose(i, 5 + i % 30)) for i in range(200)]
    sources = [f"s{i % 4}" for i in range(200)]

    def pieces(df):
        return sorted(map(repr, df.select("doc_id", "pieces").collect()))

    df = table(spark, rows, sources)
    assert pieces(mix_sources(df)) == pieces(mix_sources(df.repartition(7)))


def test_mixed_documents(spark, folder):
    rows = [(i, prose(i, 5 + i % 30)) for i in range(100)] + [(500, None), (501, "")]
    df = table(spark, rows, ["a" if i < 90 else "b" for i in range(102)])
    taken = {r.doc_id: sum(p.n_words for p in r.pieces) for r in mix_sources(df).collect()}
    out = mixed_documents(df)
    assert out.columns == df.columns
    found = {}
    texts = dict(rows)
    for r in out.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + len(r.text.split())
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert found == {d: n for d, n in taken.items() if n}
    write_mix(df, f"{folder}/mix")
    back = spark.read.parquet(f"{folder}/mix")
    assert back.agg({"n_words": "sum"}).first()[0] == sum(taken.values())


def test_empty_tables(spark):
    empty = table(spark, hard_texts(), ["a"] * len(hard_texts())).limit(0)
    assert mix_sources(empty).count() == 0 and mixed_documents(empty).count() == 0
    wordless = table(spark, [(1, None), (2, " ")], ["a", None])
    assert [r.pieces for r in mix_sources(wordless).collect()] == [[], []]


def test_mixed_documents_without_own_ids(spark):
    # a third of the rows has no id and another third has one id, with texts of different lengths
    rows = [([None, 7, i][i % 3], f"w{i} " * (3 + i % 30)) for i in range(150)]
    sources = ["a" if i < 100 else "b" for i in range(150)]
    sizes = [sum(len(t.split()) for (_, t), s in zip(rows, sources) if s == name) for name in "ab"]
    got, times = {"a": 0, "b": 0}, {}
    for r in mixed_documents(table(spark, rows, sources)).collect():
        own = r.text.split()
        i = int(own[0][1:])
        assert set(own) == {f"w{i}"} and (r.doc_id, r.source) == (rows[i][0], sources[i])
        got[r.source] += len(own)
        times.setdefault(i, []).append(len(own))
    assert [got[name] for name in "ab"] == [round(t) for t in targets(sizes)]
    assert max(map(len, times.values())) <= 2
    cut = [n for i, taken in times.items() for n in taken if n < 3 + i % 30]
    assert len(cut) <= 2  # the last document of a source only


def test_taken_words_are_those_of_the_shards_runs(spark):
    """The tree's runs laid out word by word, in the stream's order as the pieces show it."""
    rows = [(i, prose(i, 5 + i % 30)) for i in range(150)]
    found = mix_sources(table(spark, rows, ["ab"[i % 3 > 0] for i in range(150)]), 5, 60).collect()
    for source, size in {(r.source, r.source_size) for r in found}:
        own = [(p.block, p.shard, p.n_words) for r in found if r.source == source for p in r.pieces]
        blocks = {}
        for block, shard, n in own:
            blocks.setdefault((block, shard), []).append(n)
        # one shard per block, shards own runs of blocks, and all blocks but the last are full
        order = sorted(blocks)
        assert [b for b, _ in order] == list(range(len(order)))
        assert [s for _, s in order] == sorted(s for _, s in order)
        full = {sum(blocks[key]) for key in order[:-1]}
        assert len(full) == 1 and 0 < sum(blocks[order[-1]]) <= full.pop()
        assert sum(n for _, _, n in own) <= 2 * size


def test_mixed_rows_lie_by_shard(spark):
    rows = [(i, prose(i, 5 + i % 30)) for i in range(200)]
    df = table(spark, rows, ["ab"[i % 2] for i in range(200)])
    # a whole document's rows differ by their shards, so those tell the order of the rows
    first = {}
    for r in mix_sources(df).collect():
        for copy in {p.copy for p in r.pieces}:
            first.setdefault(r.doc_id, set()).add(next(p.shard for p in r.pieces if p.copy == copy))
    out = [r.doc_id for r in mixed_documents(df).coalesce(1).collect()]
    sure = [min(first[d]) for d in out if len(first[d]) == 1]
    falls = sum(a > b for a, b in zip(sure, sure[1:]))
    assert len(sure) > 50 and falls < 8  # at most one fall per partition
    assert out != sorted(out)


def test_sources_are_sent_to_the_rows(spark):
    rows = [(i, prose(i % 4, 30 + i)) for i in range(40)]
    mixed = mix_sources(table(spark, rows, ["a", "b", None, "c"] * 10))
    assert len(mixed.collect()) == 40
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    of_sources = [line for line in plan.splitlines() if "Join" in line and "_source" in line]
    assert of_sources and all("BuildRight" in line for line in of_sources)
