import zlib

import pytest
from llm_cases import documents, hard_texts, prose

from tallyrec.llm.sharding import assign_shards, write_shards


def rows_of(n):
    """A third of the documents are copies of one text."""
    return [(i, "the very same" if i % 3 == 0 else prose(i, i % 50)) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"max_range_rows": 20}, {"n_shards": 5}, {"n_shards": 1}])
def test_equal_bytes(spark, options):
    rows = rows_of(900) + [(10_000 + (i or 0), t) for i, t in hard_texts() if i != 10]
    found = assign_shards(spark.createDataFrame(documents(rows)), **options).collect()
    texts = dict(rows)
    n_shards = options.get("n_shards", 24)
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows)
    for r in found:
        data = (texts[r.doc_id] or "").encode()
        assert r.size == len(data) + 8 or r.doc_id >= 10_000
        assert r.text_crc32 == zlib.crc32(data) or r.doc_id >= 10_000
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < n_shards
    share = sum(r.size for r in found) / n_shards
    largest = max(r.size for r in found)
    for shard in range(n_shards):
        own = [r for r in found if r.shard == shard]
        assert abs(sum(r.size for r in own) - share) <= largest
        assert sorted(r.slot for r in own) == list(range(len(own)))
    # equal texts lie side by side: a text is in neighbouring shards only
    for crc in {r.text_crc32 for r in found}:
        shards = {r.shard for r in found if r.text_crc32 == crc}
        assert max(shards) - min(shards) == len(shards) - 1


def test_hard_rows(spark):
    rows = hard_texts()
    found = assign_shards(spark.createDataFrame(documents(rows)), n_shards=3, carry=("text",))
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=repr) == sorted(rows, key=repr)
    empty = spark.createDataFrame(documents(rows)).limit(0)
    assert assign_shards(empty).count() == 0
    same = spark.createDataFrame(documents([(None, None)] * 50))
    sizes = [r["count"] for r in assign_shards(same, n_shards=5).groupBy("shard").count().collect()]
    assert sizes == [10] * 5


def test_sampled_ranges_are_subdivided(spark):
    from pyspark.sql import functions as F

    from tallyrec.llm.ranges import range_of
    from tallyrec.llm.sharding import _subdivide

    keyed = spark.range(4000).select(
        F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("key"), F.col("id").alias("row")
    )
    splitters = _subdivide(keyed, [1 << 39], 100)
    sizes = keyed.groupBy(range_of(F.col("key"), splitters)).count().collect()
    assert max(n for _, n in sizes) <= 200
    keys = [r.key for r in keyed.collect()]
    found = keyed.select("key", range_of(F.col("key"), splitters).alias("r")).collect()
    assert all(r.r == sum(s <= r.key for s in splitters) for r in found[:200]) and len(keys) == 4000


def test_written_shards(spark, folder):
    rows = rows_of(100)
    write_shards(spark.createDataFrame(documents(rows)), f"{folder}/out", 4)
    back = spark.read.parquet(f"{folder}/out")
    assert sorted((r.doc_id, r.text) for r in back.collect()) == rows
