import pytest
from pyspark.sql import functions as F

from tallyrec.functions import columns as c


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "number"),
    [("4", 4.0), (" 4 ", 4.0), ("+4", 4.0), ("4.", 4.0), ("1e0", 1.0), ("4d", None), ("4.5F", None),
     ("x", None), ("", None), (None, None)],
)
def test_to_number_rejects_what_is_not_a_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(c.to_number(df, "v")).first()[0] == number


@pytest.mark.parametrize(
    ("value", "kind", "whole"),
    [("12", "string", 12), ("12.0", "string", 12), ("12.7", "string", None), ("x", "string", None),
     ("9007199254740993", "string", 9007199254740993), (4.0, "double", 4), (4.7, "double", None),
     (float("nan"), "double", None), (1e300, "double", None), (7, "int", 7)],
)
def test_to_whole_number_keeps_whole_values_only(spark, value, kind, whole):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    assert df.select(c.to_whole_number(df, "v")).first()[0] == whole


@pytest.mark.parametrize(
    ("seconds", "month"),
    [(0, "1970-01"), (1_609_459_199, "2020-12"), (1_609_459_200, "2021-01"), (-1, "1969-12"),
     (1_600_000_000_000, None), (None, None)],
)
@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_month_is_utc_in_any_session_zone(spark, seconds, month, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, c.unix_timestamp_to_month(F.lit(seconds).cast("bigint"))) == month
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_milliseconds_are_out_of_range(spark):
    assert one(spark, c.unix_timestamp_to_time(F.lit(1_600_000_000_000))) is None


@pytest.mark.parametrize(
    ("kind", "value", "flat"),
    [("array<array<string>>", [["a", "b"], ["c"]], "b"), ("array<array<string>>", [], None),
     ("array<array<string>>", [[]], None), ("array<string>", ["a", "b"], "b"),
     ("array<string>", [], None), ("array<string>", None, None), ("string", "a", "a")],
)
def test_flatten_category(spark, kind, value, flat):
    df = spark.createDataFrame([(value,)], f"category {kind}")
    assert df.select(c.flatten_category(df)).first()[0] == flat


@pytest.mark.parametrize(
    ("kind", "value", "flat"),
    [("array<string>", ["a", "", None, "b"], "a b"), ("array<string>", ["", None], None),
     ("array<string>", [], None), ("array<string>", None, None), ("string", "a", "a")],
)
def test_flatten_description(spark, kind, value, flat):
    df = spark.createDataFrame([(value,)], f"description {kind}")
    assert df.select(c.flatten_description(df)).first()[0] == flat


def test_sparsity_of_an_empty_matrix_is_one(spark):
    assert one(spark, c.sparsity(F.lit(0), F.lit(5), F.lit(0))) == 1.0
    assert one(spark, c.sparsity(F.lit(4), F.lit(5), F.lit(5))) == 0.75
    assert one(spark, c.density(F.lit(4), F.lit(5), F.lit(5))) == 0.25


@pytest.mark.parametrize(("share", "bar"), [(0.0, ""), (0.25, "#" * 10), (0.2499, "#" * 9), (1.0, "#" * 40)])
def test_share_bar(spark, share, bar):
    assert one(spark, c.share_bar(F.lit(share))) == bar


@pytest.mark.parametrize(("value", "digits", "result"), [(0.12345, 4, 0.1235), (0.12344, 4, 0.1234), (-0.5, 0, 0.0)])
def test_round_half_up(spark, value, digits, result):
    assert one(spark, c.round_half_up(F.lit(value), digits)) == result


def test_unit_scale_of_a_constant_row_is_zero(spark):
    assert one(spark, c.unit_scale(F.lit(3.0), F.lit(3.0), F.lit(3.0))) == 0.0
    assert one(spark, c.unit_scale(F.lit(2.0), F.lit(1.0), F.lit(3.0))) == 0.5


def test_l2_normalize(spark):
    unit = one(spark, c.l2_normalize(F.array(F.lit(3.0), F.lit(4.0))))
    assert unit == pytest.approx([0.6, 0.8])
    assert one(spark, c.l2_normalize(F.array(F.lit(0.0), F.lit(0.0)))) == [0.0, 0.0]
