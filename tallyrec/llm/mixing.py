"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is a stream of words: its documents in an order given by a hash, passed twice at most.
The words the mix takes from a source are the front of that stream, cut into blocks. A tree over
the output shards splits the blocks: each node divides the block quotas of its sources between its
two halves by draws without replacement (a multivariate hypergeometric draw), so every shard holds
the same number of blocks, and the quotas of a source add up exactly. A shard then owns a
run of each source's permuted stream; runs are disjoint, and inside a shard pieces are ordered by a
hash. What a document gives is what the shards' runs take of it, and nothing else.

The driver plans with one figure per source and shard. Documents never leave the cluster: their
places in the streams are added up in hash buckets of about the square root of a source's rows, so
neither a bucket nor the list of bucket totals of a source with a third of all rows is large.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrec.llm.batches import unused
from tallyrec.session import materialize

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)  # by rank of the source, repeating
SHARE = 1.5  # of all words
MAX_REPEATS = 2
N_SHARDS = 24
N_BLOCKS = 65536  # the mix is cut into about so many blocks
SEED = 606
_LEAST_BUCKET_ROWS = 64


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: list[int]) -> list[float]:
    """Words to take from each source, given their sizes in the order of the weights.

    All words times ``SHARE`` are shared by weight; no source gives more than twice its size, and
    what is cut off is shared again by weight among the others.
    """
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))]
    found: dict[int, float] = {}
    left, open_ = SHARE * sum(sizes), set(range(len(sizes)))
    while open_:
        of_all = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / of_all > MAX_REPEATS * sizes[i]}
        if not over:
            found |= {i: left * weights[i] / of_all for i in open_}
            break
        found |= {i: float(MAX_REPEATS * sizes[i]) for i in over}
        left -= sum(MAX_REPEATS * sizes[i] for i in over)
        open_ -= over
    return [found[i] for i in range(len(sizes))]


def split_quotas(quotas: list[int], n_shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks by source and shard. Every shard gets the same number of blocks, give or take one."""
    out = np.zeros((len(quotas), n_shards), np.int64)

    def split(low: int, high: int, blocks: np.ndarray) -> None:
        if high - low == 1:
            out[:, low] = blocks
            return
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        draws = int(blocks.sum()) * (middle - low) // (high - low)
        left = np.zeros_like(blocks)
        rest = int(blocks.sum())
        for i, own in enumerate(blocks.tolist()):
            rest -= own
            left[i] = rng.hypergeometric(own, rest, draws) if draws and own else 0
            draws -= int(left[i])
        split(low, middle, left)
        split(middle, high, blocks - left)

    split(0, n_shards, np.array(quotas, np.int64))
    return out


def _plan(sources: list, n_shards: int, n_blocks: int) -> str:
    """One JSON record per source: its target, and the run of its stream that each shard takes."""
    sizes = [row["source_size"] for row in sources]
    wanted = targets(sizes)
    words = [min(round(t), MAX_REPEATS * s) for t, s in zip(wanted, sizes, strict=True)]
    block = max(1, -(-sum(words) // n_blocks))
    quotas = split_quotas([-(-w // block) for w in words], n_shards)
    return json.dumps(
        [
            {
                "rank": i,
                "target": wanted[i],
                "block_words": block,
                "runs": _runs(quotas[i], block, words[i]),
            }
            for i in range(len(sources))
        ]
    )


def _runs(quotas: np.ndarray, block: int, words: int) -> list[dict[str, int]]:
    """The words of a source's stream from ``low`` to ``high`` for each shard that has blocks of it."""
    ends = np.cumsum(quotas)
    return [
        {"shard": shard, "low": int(end - own) * block, "high": min(int(end) * block, words)}
        for shard, (own, end) in enumerate(zip(quotas, ends, strict=True))
        if own
    ]


def mix_sources(
    docs: DataFrame, n_shards: int = N_SHARDS, n_blocks: int = N_BLOCKS, carry: Sequence[str] = ()
) -> DataFrame:
    """What the mix takes from every document.

    Sources in the order of their code points, null last, weigh 3, 1, 2 and so on. Returns, one row
    per row of ``docs``: ``doc_id``, ``source``, ``size`` (words), ``source_size``, ``target`` (words
    to take from the source), the columns named in ``carry`` and ``pieces``, an array of ``copy`` (0 or 1), ``shard``, ``block``,
    ``first_word`` (from 0) and ``n_words``. A source's pieces add up to its target, rounded to a
    word, and a document is taken twice at most. Everything depends on the rows only, so another
    run gives the same mix.

    A null text has no words and is never taken; neither are empty ones. Null is a source of its own.
    Rows that repeat a document are documents of their own. Columns other than ``doc_id``,
    ``source`` and ``text`` are ignored; an empty table gives an empty result. The number of
    sources must fit the driver; that of documents need not.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words(text).alias("size"),
        F.xxhash64(F.lit(SEED), F.col("doc_id"), text).alias("turn"),
        *[F.col(name).alias(f"_{i}") for i, name in enumerate(carry)],
    )
    slim = materialize(slim, "mix-rows")
    found = slim.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    # sources by number: a join on the number needs no care for null
    ranked = found.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    )
    ranked = materialize(ranked, "mix-sources")
    plan = _plan(ranked.orderBy("rank").select("source_size").collect(), n_shards, n_blocks)
    schema = (
        "array<struct<rank:int,target:double,block_words:bigint,"
        "runs:array<struct<shard:int,low:bigint,high:bigint>>>>"
    )
    planned = spark.range(1).select(F.inline(F.from_json(F.lit(plan), schema)))
    sources = ranked.join(planned, "rank").withColumnRenamed("source", "_source")

    same = F.col("source").eqNullSafe(F.col("_source"))
    rows_each = F.greatest(F.lit(_LEAST_BUCKET_ROWS), F.sqrt("rows"))
    # Spark takes the sources for a large table, after the inline, and would rather send out the rows
    known = slim.join(F.broadcast(sources), same).withColumn(
        "bucket", F.pmod("turn", F.ceil(F.col("rows") / rows_each))
    )
    carried = [F.col(f"_{i}") for i in range(len(carry))]
    own = Window.partitionBy("rank", "bucket").orderBy("turn", "doc_id", *carried)
    until = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        known.groupBy("rank", "bucket")
        .agg(F.sum("size").alias("words_inside"))
        .select("rank", "bucket", F.coalesce(F.sum("words_inside").over(until), F.lit(0)).alias("skip"))
    )
    running = F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0))
    placed = known.withColumn("running", running).join(starts, ["rank", "bucket"])
    placed = placed.withColumn("start", F.col("skip") + F.col("running") - F.col("size"))
    copies = [_pieces(copy) for copy in range(MAX_REPEATS)]
    return placed.select(
        *("doc_id", "source", "size", "source_size", "target"),
        *[column.alias(name) for column, name in zip(carried, carry, strict=True)],
        F.concat(*copies).alias("pieces"),
    )


def _pieces(copy: int) -> Column:
    """What the shards take of one pass of a document, run by run and block by block."""
    at = F.col("start") + copy * F.col("source_size")
    end = at + F.col("size")
    width = F.col("block_words")

    def of_run(run: Column) -> Column:
        def of_block(block: Column) -> Column:
            low = F.greatest(at, run["low"], block * width)
            high = F.least(end, run["high"], (block + 1) * width)
            return F.struct(
                F.lit(copy).alias("copy"),
                run["shard"].alias("shard"),
                block.alias("block"),
                (low - at).alias("first_word"),
                (high - low).alias("n_words"),
            )

        first = F.floor(F.greatest(at, run["low"]) / width)
        last = F.floor((F.least(end, run["high"]) - 1) / width)
        return F.transform(F.sequence(first, last), of_block)

    # an empty document meets no run
    met = F.filter("runs", lambda run: F.greatest(at, run["low"]) < F.least(end, run["high"]))
    kind = "array<struct<copy:int,shard:int,block:bigint,first_word:bigint,n_words:bigint>>"
    return F.flatten(F.transform(met, of_run)).cast(kind)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as a corpus: the columns of ``docs`` with a row for each time a document is taken.

    A document that is taken in part, at the end of its source's words, keeps its first words,
    joined by single spaces. ``docs`` needs ``doc_id``, ``source`` and ``text``; ``n_chars`` is set
    anew if it is there. Every output partition has its shards one after the other, a row in the shard
    of its first words, and each shard in an order given by a hash. Each row is taken as the mix takes it, whatever rows share its ``doc_id`` or
    have none: rows are told apart by a number that is written once. Further columns may have any
    names.
    """
    columns = docs.columns
    helpers = ("_row", "_size", "_copy", "_taken", "_shard", "_turn")
    row, size, copy, words, shard, turn = (unused(columns, name) for name in helpers)
    docs = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "mix-documents")
    taken = mix_sources(docs, carry=[row]).select(
        row,
        F.col("size").alias(size),
        F.inline(F.array(*map(_of_copy, range(MAX_REPEATS)))).alias(copy, shard, words),
    )
    taken = taken.where(F.col(words) > 0)
    taken = taken.withColumn(turn, F.xxhash64(F.lit(SEED + 1), row, copy))
    text = F.col("text")
    front = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORDS), 0), 1, F.col(words)), " ")
    joined = docs.join(taken, row).withColumn(
        "text", F.when(F.col(words) < F.col(size), front).otherwise(text)
    )
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.sortWithinPartitions(shard, turn).select(*columns)


def _of_copy(copy: int) -> Column:
    """The first shard of one pass of a document, and the words that all shards take of it."""
    own = F.filter("pieces", lambda piece: piece["copy"] == copy)
    words = F.aggregate(own, F.lit(0).cast("long"), lambda n, piece: n + piece["n_words"])
    shard = F.try_element_at(own, F.lit(1))["shard"]
    return F.struct(F.lit(copy), shard, words)


def write_mix(docs: DataFrame, path: str) -> None:
    """Write the mix's pieces as Parquet, one folder per shard, each shard in a shuffled order."""
    pieces = mix_sources(docs).select("doc_id", "source", F.inline("pieces"))
    turn = F.xxhash64(F.lit(SEED + 1), "block", "doc_id", "copy")
    dealt = pieces.withColumn("turn", turn).repartitionByRange("shard", "turn")
    dealt.sortWithinPartitions("shard", "turn").write.partitionBy("shard").parquet(path)
