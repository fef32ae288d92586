"""Sharding into contiguous ranges of equal size by sampled splitters.

Rows are ordered by a key that starts with the checksum of the text, so equal texts lie together.
Keys are sampled with a probability in proportion to size, the quantiles of the sample cut the
key into ranges, and a range that holds too many rows is subdivided by a second sample of its own
rows. Sizes are then added up inside the ranges in parallel, the range totals are added up, and the
place of a row on the line of all bytes names its shard. No group is larger than a range, whatever
the size of the largest group of equal texts: a group is cut where a shard is full.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyrec.llm.ranges import range_of
from tallyrec.session import materialize

N_SHARDS = 24
ROW_BYTES = 8  # what a row counts besides its text
RANGES_PER_SHARD = 8
DRAWS_PER_RANGE = 32
MAX_RANGE_ROWS = 1_000_000
SEED = 4242

_KEY_BITS = 31


def _uniform(*columns: str) -> Column:
    """A number in [0, 1) that depends on the columns only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *columns), 11) / F.lit(float(1 << 53))


def _splitters(rows: DataFrame, weight: Column, total: int, n_ranges: int) -> list[int]:
    """Quantiles of the key in a sample drawn by weight, at most ``n_ranges - 1`` of them.

    The driver sees ``DRAWS_PER_RANGE`` draws per range on average.
    """
    if n_ranges < 2 or not total:
        return []
    rate = n_ranges * DRAWS_PER_RANGE / total
    drawn = rows.select("key", F.floor(weight * rate + _uniform("key", "row")).alias("draws"))
    sample = drawn.where("draws > 0").groupBy("key").agg(F.sum("draws")).orderBy("key").collect()
    all_draws = sum(draws for _, draws in sample)
    found, seen = [], 0
    for key, draws in sample:
        if seen * n_ranges // all_draws < (seen + draws) * n_ranges // all_draws and seen:
            found.append(key)
        seen += draws
    return found


def assign_shards(
    docs: DataFrame,
    n_shards: int = N_SHARDS,
    carry: Sequence[str] = (),
    max_range_rows: int = MAX_RANGE_ROWS,
) -> DataFrame:
    """A shard for every row so that all shards hold nearly the same number of bytes.

    A row's size is the UTF-8 length of its text (none for null) plus eight. Rows are laid end to
    end, equal texts side by side, and the line is cut into ``n_shards`` equal parts; a row
    belongs to the part that holds its middle, so a shard is off by no more than one row at each
    end. Returns ``doc_id``, ``size``, ``text_crc32`` (unsigned; null counts as empty), ``law``
    (``bytes``), ``shard``, ``slot`` (from 0 without gaps inside the shard), ``grown_shard`` (null)
    and the columns named in ``carry``.

    Null ids, null and empty texts and repeated rows are rows like any other. With fewer rows than
    shards some shards stay empty; an empty table gives an empty result.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
        *[F.col(name).alias(f"_carry{i}") for i, name in enumerate(carry)],
    )
    # written, so that row numbers stay what they are
    slim = materialize(slim, "shard-rows")
    inside = F.xxhash64("doc_id", "row").bitwiseAND(F.lit((1 << _KEY_BITS) - 1))
    keyed = slim.withColumn("key", F.shiftleft("text_crc32", _KEY_BITS).bitwiseOR(inside))

    total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    splitters = _splitters(keyed, F.col("size"), total, n_shards * RANGES_PER_SHARD)
    splitters = _subdivide(keyed, splitters, max_range_rows)
    ranged = keyed.withColumn("range", range_of(F.col("key"), splitters))

    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    starts = totals.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("first_byte"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first_row"),
    )
    own = Window.partitionBy("range").orderBy("key", "row")
    placed = (
        ranged.withColumn("byte", F.sum("size").over(own) - F.col("size"))
        .withColumn("place", F.row_number().over(own) - 1)
        .join(starts, "range")
        .withColumn("byte", F.col("byte") + F.col("first_byte"))
        .withColumn("place", F.col("place") + F.col("first_row"))
    )
    middle = 2 * F.col("byte") + F.col("size")
    shard = F.floor(middle.cast("decimal(38,0)") * n_shards / F.lit(2 * max(total, 1)))
    placed = placed.withColumn("shard", F.least(shard.cast("int"), F.lit(n_shards - 1)))
    placed = materialize(placed.drop("range", "first_byte", "first_row", "key"), "shard-places")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(first, "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *[F.col(f"_carry{i}").alias(name) for i, name in enumerate(carry)],
    )


def _subdivide(keyed: DataFrame, splitters: list[int], max_range_rows: int) -> list[int]:
    """More splitters inside the ranges of more than ``max_range_rows`` rows, at most one for
    every half as many rows."""
    ranged = keyed.withColumn("range", range_of(F.col("key"), splitters))
    counts = ranged.groupBy("range").count().where(F.col("count") > max_range_rows).collect()
    overfull = sorted(r for r, _ in counts)
    if not overfull:
        return splitters
    n_rows = sum(n for _, n in counts)
    pieces = -(-2 * n_rows // max_range_rows)
    inside = F.array_contains(F.array(*[F.lit(r) for r in overfull]), F.col("range"))
    more = _splitters(ranged.where(inside), F.lit(1.0), n_rows, pieces)
    return sorted({*splitters, *more})


def write_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS) -> None:
    """Write ``doc_id``, ``slot`` and ``text`` as Parquet, one folder per shard, in slot order."""
    rows = assign_shards(docs, n_shards, carry=("text",))
    ordered = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.select("shard", "slot", "doc_id", "text").write.partitionBy("shard").parquet(path)
