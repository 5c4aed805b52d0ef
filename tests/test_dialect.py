"""Semantics that differ silently between engines."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from opsgrain.functions.dates import business_days_between
from opsgrain.functions.dialect import (
    array_slice0, compare, convert_tz, datediff_boundary, digits_number, full_match, ilike_any, like_plain, null_as_other, percent_text,
    regexp_first, safe_ratio, same_time_of_day_or_earlier, time_slice, trunc, whole_number,
)


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    ("unit", "a", "b", "expected"),
    [
        ("minute", "2024-01-01 00:00:59", "2024-01-01 00:01:00", 1),
        ("second", "2024-01-01 00:00:59.9", "2024-01-01 00:01:00.1", 1),
        ("hour", "2024-01-01 10:59:59", "2024-01-01 11:00:00", 1),
        ("day", "2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
        ("day", "2024-01-02 00:00:00", "2024-01-01 23:59:59", -1),
        ("week", "2024-01-07 23:00:00", "2024-01-08 00:00:00", 1),
        ("month", "2024-01-31 00:00:00", "2024-02-01 00:00:00", 1),
        ("quarter", "2023-12-31 00:00:00", "2024-01-01 00:00:00", 1),
        ("year", "2023-12-31 23:59:59", "2024-01-01 00:00:00", 1),
        ("minutes", "1969-12-31 23:59:30", "1970-01-01 00:00:30", 1),
    ],
)
def test_boundary_difference(spark, unit, a, b, expected):
    assert one(spark, datediff_boundary(unit, ts(a), ts(b))) == expected


@pytest.mark.parametrize(
    ("local", "utc"),
    [
        ("2024-03-10 01:30:00", datetime(2024, 3, 10, 9, 30)),
        ("2024-03-10 03:30:00", datetime(2024, 3, 10, 10, 30)),
        ("2024-11-02 12:00:00", datetime(2024, 11, 2, 19, 0)),
        ("2024-11-03 12:00:00", datetime(2024, 11, 3, 20, 0)),
    ],
)
def test_zone_shift_knows_daylight_saving(spark, local, utc):
    assert one(spark, convert_tz(ts(local), "America/Los_Angeles", "UTC")) == utc


def test_truncation_keeps_wall_clock_type(spark):
    df = spark.range(1).select(trunc("week", ts("2024-01-07 10:00:00")).alias("w"), time_slice(ts("2024-01-01 10:44:59"), 30, end=True).alias("s"))
    assert [f.dataType.typeName() for f in df.schema.fields] == ["timestamp_ntz"] * 2
    assert tuple(df.first()) == (datetime(2024, 1, 1), datetime(2024, 1, 1, 11, 0))


def test_patterns(spark):
    assert one(spark, full_match(F.lit("chat this"), "chat")) is False
    assert one(spark, full_match(F.lit("chat this"), "chat.+.")) is True
    assert one(spark, full_match(F.lit("000-00-000a"), "[0-9]{3}-[0-9]{2}-[0-9]{4}")) is False
    assert one(spark, like_plain(F.lit("#AR_DL"), "%ar_dl%", ignore_case=True)) is True
    assert one(spark, like_plain(F.lit("#ARxDL"), "%ar!_dl%", escape="!", ignore_case=True)) is False
    assert one(spark, like_plain(F.lit("a\\b"), "a\\b")) is True
    assert one(spark, ilike_any(F.lit("Sick leave"), ["%vacation%", "%SICK%"])) is True
    assert one(spark, regexp_first(F.lit("ref 123456789 and 87654321"), "[0-9]{8}([0-9]{1})?")) == "123456789"
    assert one(spark, regexp_first(F.lit("nothing"), "[0-9]{8}")) is None
    assert one(spark, digits_number(F.lit("No 12.5x"))) == 12.5
    assert one(spark, digits_number(F.lit("none"))) is None


def test_numbers_and_slices(spark):
    assert one(spark, safe_ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, safe_ratio(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(spark, safe_ratio(F.lit(1), F.lit(3), 100, 2)) == 33.33
    assert int(one(spark, whole_number(F.lit(2.5)))) == 3
    assert one(spark, percent_text(F.lit(41.5))) == "42%"
    arr = F.array(*[F.lit(x) for x in "abcd"])
    assert one(spark, array_slice0(arr, 0, 2)) == ["a", "b"]
    assert one(spark, array_slice0(arr, 3, 2)) == []
    assert one(spark, null_as_other(F.lit(None).cast("string"))) == "other"


def test_comparisons(spark):
    assert one(spark, compare(F.lit("3.10.0"), ">", "3.9.0")) is False
    assert one(spark, compare(F.lit("3.10.0"), "Greater Than", "3.9.0", numeric_version=True)) is True
    with pytest.raises(ValueError):
        compare(F.lit("1"), "; drop", "2")
    now = ts("2024-01-05 14:00:00")
    assert one(spark, same_time_of_day_or_earlier(ts("2023-05-05 05:59:00"), now, 8)) is True
    assert one(spark, same_time_of_day_or_earlier(ts("2023-05-05 06:01:00"), now, 8)) is False


@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [
        ("2024-01-05", "2024-01-08", 1),  # Friday to Monday
        ("2024-01-06", "2024-01-08", 1),  # Saturday to Monday
        ("2024-01-06", "2024-01-07", 0),  # weekend
        ("2024-01-08", "2024-01-08", 0),
        ("2024-01-08", "2024-01-15", 5),
        ("2024-01-15", "2024-01-08", -5),
        ("1969-12-29", "1970-01-05", 5),
    ],
)
def test_business_days(spark, a, b, expected):
    assert one(spark, business_days_between(F.lit(a).cast("date"), F.lit(b).cast("date"))) == expected


def test_business_days_null_and_holidays(spark):
    a, b = F.lit("2024-01-12").cast("date"), F.lit("2024-01-17").cast("date")
    assert one(spark, business_days_between(a, F.lit(None).cast("date"))) is None
    assert one(spark, business_days_between(a, b, [date(2024, 1, 15), date(2024, 1, 14)])) == 2
    assert one(spark, business_days_between(b, a, [date(2024, 1, 15)])) == -2
