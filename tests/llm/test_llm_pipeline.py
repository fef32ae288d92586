import numpy as np
import public_tokenizers
import tiktoken
from llm_cases import documents, hard_texts, prose

import corpus_pipeline
from tallyrec.llm.bpe import read_ranks


def test_stages(spark):
    passage = prose(77, 60)
    rows = [*hard_texts(), (40, "12 34 -- !")]
    rows += [(50 + i, f"{prose(300 + i, 80)} {passage}") for i in range(12)]
    docs = spark.createDataFrame(documents(rows))
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.toArrow())
        seen[name] = sorted((r.doc_id, r.text) for r in docs.where("doc_id is not null").collect())
    kept = {d for d, _ in seen["language ID"]}
    assert {3, 4, 5, 40}.isdisjoint(kept) and {0, 1, 2, 6, 50, 61} <= kept
    kept = {d for d, _ in seen["simhash near-dedup"]}
    assert 0 in kept and 1 not in kept and {50, 55, 61} <= kept
    texts = dict(seen["substring dedup"])
    assert passage in texts[50] and passage not in texts[51]
    assert texts[51].split() == prose(301, 80).split()
    assert texts[50] == dict(rows)[50]  # untouched, white space included
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    ranks = read_ranks(public_tokenizers.path(corpus_pipeline.RANKS))
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = sorted((r.doc_id is None, r.doc_id or 0, other.encode_ordinary(r.text)) for r in docs.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in last) == wanted


def test_near_duplicates_by_row(spark):
    texts = {name: prose(seed, 90) for name, seed in zip("abcdef", range(900, 906))}
    rows = [(1, "a"), (None, "a"), (None, "b"), (3, "c"), (5, "c"), (5, "d"), (8, "d")]
    rows += [(None, "e"), (None, "e"), (9, "f"), (9, "f"), (9, "f")]
    docs = spark.createDataFrame(documents([(i, texts[name]) for i, name in rows]))
    found = corpus_pipeline.near_duplicates(spark, docs, "")
    assert found.columns == docs.columns
    names = {text: name for name, text in texts.items()}
    kept = sorted((names[r.text], r.doc_id) for r in found.collect())
    assert kept == [("a", 1), ("b", None), ("c", 3), ("d", 5), ("e", None), ("f", 9)]


def test_run_on_given_table(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    words = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert 0 < found.count() <= 2 * words
    assert np.all([r.n_tokens == len(r.ids) for r in found.collect()])


def test_columns_of_any_names(spark):
    names = ("_row", "_ROW_", "_size", "_taken", "_copy", "_lang_pred", "_score", "row", "places", "is_copy")
    rows = [(i, f"{prose(i // 2, 40)} {prose(700, 30)}") for i in range(12)]
    table = documents(rows, **{name: [name] * len(rows) for name in names}).drop_columns(["n_chars"])
    docs = spark.createDataFrame(table)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        found = out.toArrow()
        assert found.num_rows
        assert all(set(found[name].to_pylist()) == {name} for name in names)
        docs = spark.createDataFrame(found)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()
