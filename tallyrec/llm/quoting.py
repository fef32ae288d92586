"""Reply-ordered conversations by quotation linking.

Lines that start with ``>`` are quotes, and the number of these marks is their level. Neighbouring lines
of one level without a blank one between them are a passage. Passages and their lines are
normalised and hashed; a hash joins a quote to the first message of the conversation that says
the same in its own words. The original of a message's outermost quote is the message it answers.
Answers form threads, whose roots are found by pointer doubling.

Lines are taken apart inside the rows, with array functions. Only hashes are shuffled, by conversation
and hash: a conversation with a third of all messages is spread like any other, and what many
messages say alike is one row before it is joined.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrec.session import materialize, shared_folder

MARKS = r"^((?:[ \t]*>)+)"
# How mail programs announce a quote, in four languages.
ATTRIBUTION = r"(?i)^(on|am|le|el)\s.*(wrote|schrieb.*|écrit|escribió)\s*:\s*$"
_LINE_END = r"\r\n|\r|\n"
_EDGES = r"^(?:[ \t]*\n)+|(?:\n[ \t]*)+$"


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _lines(text: Column) -> Column:
    """An array of the lines with ``level``, ``content`` and ``blank``."""

    def line(value: Column) -> Column:
        marks = F.regexp_extract(value, MARKS, 1)
        level = F.length(F.translate(marks, " \t", ""))
        content = F.regexp_replace(value, MARKS + r"[ \t]?", "")
        content = F.when(level > 0, content).otherwise(value)
        return F.struct(
            level.alias("level"), content.alias("content"), (F.trim(content) == "").alias("blank")
        )

    return F.transform(F.split(text, _LINE_END), line)


def _normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _marked_lines(text: Column) -> Column:
    return _bind(_lines(F.coalesce(text, F.lit(""))), _with_attribution)


def _with_attribution(lines: Column) -> Column:
    """Marks the lines that announce a quote one level deeper."""

    def mark(line: Column, i: Column) -> Column:
        following = F.get(lines, i + 1)["level"]
        announces = (following > line["level"]) & line["content"].rlike(ATTRIBUTION)
        blank = line["blank"] | F.coalesce(announces, F.lit(False))
        return F.struct(
            line["level"].alias("level"),
            line["content"].alias("content"),
            blank.alias("blank"),
            F.coalesce(announces, F.lit(False)).alias("announces"),
        )

    return F.transform(lines, mark)


def _passages(lines: Column) -> Column:
    """An array of ``level`` and ``units``: the hashes of the passage and of its lines."""

    def begins(i: Column) -> Column:
        own, before = F.get(lines, i), F.get(lines, i - 1)
        new = (i == 0) | (own["level"] != before["level"]) | before["blank"]
        return ~own["blank"] & new

    def ends(i: Column) -> Column:
        own, after = F.get(lines, i), F.get(lines, i + 1)
        last = after["level"].isNull() | (own["level"] != after["level"]) | after["blank"]
        return ~own["blank"] & last

    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    spans = F.arrays_zip(
        F.filter(numbers, begins).alias("first"), F.filter(numbers, ends).alias("last")
    )

    def passage(span: Column) -> Column:
        first, last = span["first"], span["last"]
        own = F.transform(F.slice(lines, first + 1, last - first + 1), lambda line: line["content"])
        said = F.concat(F.array(F.array_join(own, " ")), own)
        said = F.filter(F.array_distinct(F.transform(said, _normal)), lambda s: s != "")
        hashes = F.transform(
            said,
            lambda s: F.struct(F.xxhash64(s).alias("hash"), F.xxhash64(F.lit(1), s).alias("hash2")),
        )
        return F.struct(F.get(lines, first)["level"].alias("level"), hashes.alias("units"))

    return F.transform(spans, passage)


def _own(lines: Column, text: Column) -> Column:
    """``text`` without quotes and ``n_quotes``."""
    kept = F.filter(lines, lambda line: (line["level"] == 0) & ~line["announces"])
    joined = F.array_join(F.transform(kept, lambda line: line["content"]), "\n")
    has_quote = F.exists(lines, lambda line: line["level"] > 0)
    quotes = F.size(F.filter(_passages(lines), lambda passage: passage["level"] > 0))
    return F.struct(
        F.when(has_quote, F.regexp_replace(joined, _EDGES, "")).otherwise(text).alias("text"),
        F.when(has_quote, quotes).otherwise(0).cast("long").alias("n_quotes"),
    )


def link_quotations(messages: DataFrame) -> DataFrame:
    """Every message without its quotes, and what it answers.

    ``messages`` has ``conv_id``, ``turn``, ``role`` and ``text``. Returns, one row per row:
    ``conv_id``, ``turn``, ``role``, ``text`` (own lines only; a message without quotes is as it
    was), ``reply_to`` (turn of the message it answers, or null), ``thread`` (turn of the first
    message of the thread), ``depth`` (answers between the two), ``n_quotes`` (quoted passages) and
    ``n_linked`` (those whose original was found). In the order of ``conv_id``, ``thread`` and ``turn``
    every answer comes after what it answers.

    A quote is linked to the first message of the same conversation, before the quoting one, that has
    the passage or one of its lines among its own, however short, with or without spaces. Of several quotes the outermost level counts, and there the latest original. A null or
    empty text has neither quotes nor own passages; messages without a conversation or turn are
    not linked. Rows that repeat a turn are all returned, and count as one message in threads.
    Other columns are ignored; an empty table gives an empty result.
    """
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(rows, "quote-rows")
    passages = _bind(_marked_lines(F.col("text")), _passages)
    spread = rows.select("conv_id", "turn", "row", F.posexplode(passages).alias("place", "passage"))
    units = spread.select(
        "conv_id",
        "turn",
        "row",
        "place",
        F.col("passage")["level"].alias("level"),
        F.inline(F.col("passage")["units"]),
    )
    originals = (
        units.where("level = 0 and conv_id is not null and turn is not null")
        .groupBy("conv_id", "hash", "hash2")
        .agg(F.min("turn").alias("original"))
    )
    linked = (
        units.where("level > 0")
        .join(originals, ["conv_id", "hash", "hash2"])
        .where("original < turn")
    )
    nearest = F.max(F.struct((-F.col("level")).alias("near"), F.col("original").alias("turn")))
    links = materialize(
        linked.groupBy("row", "conv_id", "turn")
        .agg(nearest.alias("nearest"), F.count_distinct("place").alias("n_linked"))
        .select("row", "conv_id", "turn", F.col("nearest")["turn"].alias("reply_to"), "n_linked"),
        "quote-links",
    )
    threads = _threads(links).select(
        F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), "thread", "depth"
    )
    shown = rows.select(
        "row",
        "conv_id",
        "turn",
        "role",
        _bind(_marked_lines(F.col("text")), lambda lines: _own(lines, F.col("text"))).alias("own"),
    ).select("row", "conv_id", "turn", "role", "own.*")
    same = (F.col("conv_id") == F.col("_conv")) & (F.col("turn") == F.col("_turn"))
    joined = shown.join(links.select("row", "reply_to", "n_linked"), "row", "left")
    return joined.join(threads, same, "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        "reply_to",
        F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        "n_quotes",
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
    )


def _threads(links: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``thread`` and ``depth`` of the messages that answer another.

    Each round doubles the way that every message looks back, so a thread of any length takes
    as many rounds as its length has binary digits.
    """
    spark = links.sparkSession
    folder = f"{shared_folder(spark)}/threads-{uuid.uuid4().hex}"

    def write(df: DataFrame, slot: int) -> DataFrame:
        path = f"{folder}/{slot}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    start = links.groupBy("conv_id", "turn").agg(
        F.max("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")
    )
    table, slot = write(start, 0), 0
    while True:
        further = table.select(
            "conv_id",
            F.col("turn").alias("thread"),
            F.col("thread").alias("up"),
            F.col("depth").alias("more"),
        )
        if table.join(further, ["conv_id", "thread"], "left_semi").isEmpty():
            return table
        slot = 1 - slot
        longer = table.join(further, ["conv_id", "thread"], "left").select(
            "conv_id",
            "turn",
            F.coalesce("up", "thread").alias("thread"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
        )
        table = write(longer, slot)


def write_conversations(messages: DataFrame, path: str) -> None:
    """Write the messages without quotes as Parquet, in reply order."""
    linked = link_quotations(messages)
    order = ("conv_id", "thread", "turn")
    linked.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
