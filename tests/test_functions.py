import pytest
from pyspark.sql import functions as F

from lapwise.functions.times import duration_ms, time_of_day, wall_clock, with_time_of_day
from lapwise.functions.values import (
    angle_class, correlation, flag_equal, number_or_null, ratio, row_sum, text_or_null, zero_as_null,
)


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize(
    "text, ms",
    [
        ("0 days 00:10:59.368000", 659368.0),
        ("0 days 00:00:00", 0.0),
        ("1 days 00:00:01", 86401000.0),
        ("-1 days +23:59:59", -1000.0),
        ("00:01:32.608", 92608.0),
        ("2 days", 172800000.0),
        ("1 day 01:00:00", 90000000.0),
        ("junk", None), ("", None), (None, None), ("0 days 1", None),
    ],
)
def test_duration(spark, text, ms):
    assert column(spark, [text], "string", duration_ms("v")) == [ms]


def test_hours_fall_into_parts_of_the_day(spark):
    found = column(spark, [4, 5, 11, 12, 16, 17, 20, 21, None], "int", time_of_day("v"))
    assert found == ["night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night", None]


def test_offset_is_dropped_and_bad_text_is_missing(spark):
    text = ["2023-03-03 14:30:00+03:00", "2023-03-03 14:30:00", "soon", "", None]
    assert column(spark, text, "string", F.hour(wall_clock("v"))) == [14, 14, None, None, None]


def test_time_of_day_passes_over_absent_sessions(spark):
    df = spark.createDataFrame([("2023-03-03 20:30:00-05:00",)], "Session2Date string")
    timed = with_time_of_day(df)
    assert timed.columns == ["Session2Date", "Session2Hour", "Session2TimeOfDay"]
    assert timed.first()["Session2TimeOfDay"] == "evening"


def test_corner_edges(spark):
    found = column(spark, [90.0, 60.0, -120.0, 90.5, 61.0], "double", angle_class("v"))
    assert found == ["medium", "fast", "slow", "slow", "medium"]


def test_missing_texts_and_nan(spark):
    assert column(spark, ["", "NA", "None", "nan", "null", "x"], "string", text_or_null("v")) == [None] * 5 + ["x"]
    assert column(spark, [float("nan"), 1.0, None], "double", number_or_null("v")) == [None, 1.0, None]


def test_ratio_flag_and_row_sum(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, None), (2.0, 2.0)], "a double, b double")
    found = df.select(ratio("a", "b"), flag_equal("a", "b"), row_sum(["a", "b"]), zero_as_null("b")).collect()
    assert [tuple(r) for r in found] == [(None, 0, 1.0, None), (None, 0, 1.0, None), (None, 0, 0.0, None), (1.0, 1, 4.0, 2.0)]


def test_correlation_of_a_constant_is_missing(spark):
    df = spark.createDataFrame([(1.0, 1.0, 3.0), (1.0, 2.0, 5.0), (1.0, None, 9.0)], "c double, x double, y double")
    constant, line = df.select(correlation("c", "y"), correlation("x", "y")).first()
    assert constant is None and line == pytest.approx(1.0)
