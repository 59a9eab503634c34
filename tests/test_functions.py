import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sievemark.functions import calendar, numbers


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("value,expected", [(1.005, 1.0), (2.675, 2.68), (-2.5, -2.5), (0.125, 0.13), (-0.125, -0.13)])
def test_round_scaled(spark, value, expected):
    assert one(spark, numbers.round_scaled(F.lit(value))) == expected


def test_pct(spark):
    assert one(spark, numbers.pct(F.lit(1), F.lit(8))) == 12.5
    assert one(spark, numbers.pct(F.lit(1), F.lit(0))) == 0.0


def test_diff_pct(spark):
    assert one(spark, numbers.diff_pct(F.lit(15.0), F.lit(10.0))) == 50.0
    assert one(spark, numbers.diff_pct(F.lit(15.0), F.lit(1e-13))) is None
    assert one(spark, numbers.diff_pct(F.lit(15.0), F.lit(None).cast("double"))) is None


@pytest.mark.parametrize("value,expected", [(1.5, 2), (2.5, 2), (254.6, 255), (0.4, 0)])
def test_narrow_unsigned_rounds_half_to_even(spark, value, expected):
    assert one(spark, numbers.narrow_unsigned(F.lit(value), 8, "x")) == expected


@pytest.mark.parametrize("value", [256.0, -1.0])
def test_narrow_unsigned_rejects_out_of_range(spark, value):
    with pytest.raises(PySparkException, match="out of range"):
        one(spark, numbers.narrow_unsigned(F.lit(value), 8, "x"))


def test_narrow_unsigned_keeps_null(spark):
    assert one(spark, numbers.narrow_unsigned(F.lit(None).cast("double"), 8, "x")) is None


@pytest.mark.parametrize("text", ["1", " 2.5 ", "-3e4", ".5", "+7", "NaN", "Infinity", "-inf", "abc", "", "{1}", "--1", "1x"])
def test_number_prefix_changes_nothing(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    row = df.select(
        F.col("s").try_cast("double").isNotNull().alias("plain"),
        numbers.try_narrow(F.col("s"), df.schema["s"].dataType, "double").isNotNull().alias("guarded"),
    ).first()
    assert row.plain == row.guarded


def test_plain_number(spark):
    for value, expected in ((9.5, "9.5"), (100.0, "100"), (0.0, "0"), (-994.28, "-994.28"), (12345678.0, "12345678")):
        assert one(spark, numbers.plain_number(F.lit(value))) == expected


@pytest.mark.parametrize(
    "start,end,minutes",
    [
        ("2019-01-01 00:00:59", "2019-01-01 00:01:01", 1),
        ("2019-01-01 00:00:01", "2019-01-01 00:00:59", 0),
        ("2019-01-01 23:59:30", "2019-01-02 00:00:10", 1),
        ("2019-03-10 01:30:00", "2019-03-10 03:30:00", 120),
        ("2019-01-02 00:00:00", "2019-01-01 00:00:00", -1440),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_minute_boundaries(spark, start, end, minutes, zone):
    """The result is the same in a zone with a clock change inside the span."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        a, b = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
        assert one(spark, calendar.minute_boundaries(a, b)) == minutes
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_day_type(spark):
    names = {day: one(spark, calendar.day_type(F.to_date(F.lit(day)))) for day in ("2019-06-07", "2019-06-08", "2019-06-09", "2019-06-10")}
    assert list(names.values()) == ["weekday", "weekend", "weekend", "weekday"]


def test_days_in_year():
    assert calendar.days_in_year(2019) == 365
    assert calendar.days_in_year(2020) == 366
