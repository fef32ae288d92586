"""Column expressions. All of them stay in the JVM; none needs a Python worker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The range of seconds a 64-bit nanosecond timestamp can hold
# (1677-09-21 .. 2262-04-11). Anything outside counts as unparsable.
MIN_UNIX_SECONDS = -9223372036
MAX_UNIX_SECONDS = 9223372036

SECONDS_PER_DAY = 86400

# Timestamps per second, by unit.
TIME_UNITS = {"s": 1, "ms": 1000}


def to_number(df: DataFrame, name: str) -> Column:
    """``name`` as double; values that are not numbers become null instead of failing."""
    value = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.DoubleType):
        return value
    if isinstance(kind, T.StringType):
        # Spark's cast also accepts Java's type suffixes ("4d", "4f").
        value = F.when(~value.rlike(r"[0-9.]\s*[dDfF]\s*$"), value)
    return value.try_cast("double")


def to_whole_number(df: DataFrame, name: str) -> Column:
    """``name`` as bigint; null unless the value is a whole number."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(name).cast("bigint")
    number = to_number(df, name)
    whole = F.when(number % 1 == 0, number).try_cast("bigint")
    if isinstance(kind, T.StringType):
        # The direct cast keeps digits beyond the 53 bits of a double.
        plain = F.when(F.col(name).rlike(r"^\s*[+-]?[0-9]+\s*$"), F.col(name))
        return F.coalesce(plain.try_cast("bigint"), whole)
    return whole


def as_seconds(timestamp: Column, unit: str = "s") -> Column:
    """Unix seconds from a timestamp in ``unit``: "s" or "ms". Part seconds are cut off."""
    if unit not in TIME_UNITS:
        raise ValueError(f"unknown unit {unit!r}, expected one of {sorted(TIME_UNITS)}")
    return timestamp if unit == "s" else F.floor(timestamp / TIME_UNITS[unit]).cast("bigint")


def unix_timestamp_to_time(timestamp: Column, unit: str = "s") -> Column:
    """A Unix timestamp as a time, null outside the supported range."""
    return F.timestamp_seconds(_in_range(as_seconds(timestamp, unit)))


def unix_timestamp_to_month(timestamp: Column, unit: str = "s") -> Column:
    """A Unix timestamp as ``YYYY-MM`` in UTC, whatever the session zone is."""
    day = F.date_add(
        F.lit("1970-01-01").cast("date"),
        F.floor(_in_range(as_seconds(timestamp, unit)) / SECONDS_PER_DAY).cast("int"),
    )
    return F.substring(day.cast("string"), 1, 7)


def _in_range(seconds: Column) -> Column:
    return F.when(seconds.between(MIN_UNIX_SECONDS, MAX_UNIX_SECONDS), seconds)


def flatten_category(df: DataFrame, name: str = "category") -> Column:
    """The most specific category: last entry of a list, or of the first list of a nested one."""
    value = F.col(name)
    kind = df.schema[name].dataType
    if not isinstance(kind, T.ArrayType):
        return value
    if isinstance(kind.elementType, T.ArrayType):
        value = F.try_element_at(value, F.lit(1))
    return F.try_element_at(value, F.lit(-1))


def flatten_description(df: DataFrame, name: str = "description") -> Column:
    """List parts that are neither null nor empty, joined by a space; null if none is left."""
    value = F.col(name)
    if not isinstance(df.schema[name].dataType, T.ArrayType):
        return value
    parts = F.filter(value, lambda part: part.isNotNull() & (part.cast("string") != ""))
    return F.nullif(F.array_join(parts.cast("array<string>"), " "), F.lit(""))


def product_text(title: Column, description: Column, product_id: Column) -> Column:
    """Text that represents a product: title and description, or its id when both are missing."""
    return F.when(
        title.isNull() & description.isNull(),
        F.coalesce(product_id.cast("string"), F.lit("")),
    ).otherwise(F.concat_ws(" | ", title, description))


def density(n_users: Column, n_products: Column, n_interactions: Column) -> Column:
    """Share of filled cells of the user x product matrix; 0.0 for an empty matrix."""
    # double: the product of two counts may leave the range of a bigint
    cells = n_users.cast("double") * n_products
    return F.when(cells == 0, F.lit(0.0)).otherwise(n_interactions / cells)


def sparsity(n_users: Column, n_products: Column, n_interactions: Column) -> Column:
    """Share of empty cells of the user x product matrix; 1.0 for an empty matrix."""
    return 1 - density(n_users, n_products, n_interactions)


def share_bar(share: Column, width: int = 40) -> Column:
    """A share in [0, 1] as a text bar."""
    return F.repeat(F.lit("#"), F.floor(share * width).cast("int"))


def round_half_up(value: Column, digits: int) -> Column:
    """Round by plain arithmetic, so that other engines give the same digits."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5) / scale


def unit_scale(score: Column, low: Column, high: Column) -> Column:
    """Min-max scaling to [0, 1]; a constant row becomes all zeros."""
    return F.when(high > low, (score - low) / (high - low)).otherwise(F.lit(0.0))


def dot(left: Column, right: Column) -> Column:
    """Inner product of two arrays, summed in double."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_normalize(vector: Column) -> Column:
    """The vector scaled to length 1; a zero vector stays zero."""
    length = F.sqrt(dot(vector, vector))
    return F.transform(vector, lambda x: F.when(length == 0, F.lit(0.0)).otherwise(x / length))
