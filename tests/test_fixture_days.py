"""The three single-day cases of the reference's test, with exact values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricetide import to_long
from tests.conftest import make_wide

T = dt.datetime

# The single-day inputs of the reference's unit tests.
NORMAL = ("01/05/2024", [33.42, 93.26, 63.78, None, 70.14, 49.33, 36.96, 91.36, 85.57, 91.14, 56.66, 39.76,
                         72.98, 71.23, 28.28, 89.9, 64.65, 32.04, 29.32, 48.2, 71.78, 98.48, 40.75, 84.53,
                         84.68])
AUTUMN = ("27/10/2019", [2.16, 2.88, 73.3, 21.91, 68.86, 92.62, 15.54, 13.31, 89.67, 34.94, 9.83, 43.42, 91.92,
                         42.58, 31.08, 99.67, 43.93, 99.27, 14.79, 34.13, 70.66, 51.64, 31.5, 16.42, 86.53])
SPRING = ("31/03/2019", [86.83, 88.85, None, None, 73.68, 21.91, 48.31, 80.68, 87.08, 76.69, 77.46, 73.98,
                         8.71, 53.0, 53.3, 52.63, 39.42, 94.08, 29.06, 21.26, 71.43, 5.1, 37.84, 3.19, 9.74])


def _collect(df):
    return [tuple(r) for r in df.orderBy("timestamp_utc").collect()]


def _assert_hourly(rows):
    utc = [r[1] for r in rows]
    assert all(b - a == dt.timedelta(hours=1) for a, b in zip(utc, utc[1:]))


def test_normal_day(spark, session_tz):
    rows = _collect(to_long(make_wide(spark, [NORMAL])))
    assert len(rows) == 24
    _assert_hourly(rows)
    assert rows[0] == (T(2024, 5, 1, 0), T(2024, 4, 30, 22), 33.42, "Europe/Berlin UTC+2", 2024, 5)
    assert rows[-1] == (T(2024, 5, 1, 23), T(2024, 5, 1, 21), 84.68, "Europe/Berlin UTC+2", 2024, 5)


def test_fall_back_day(spark, session_tz):
    rows = _collect(to_long(make_wide(spark, [AUTUMN])))
    assert len(rows) == 25
    _assert_hourly(rows)
    assert rows[2] == (T(2019, 10, 27, 2), T(2019, 10, 27, 0), 73.3, "Europe/Berlin UTC+2", 2019, 10)
    assert rows[3] == (T(2019, 10, 27, 2), T(2019, 10, 27, 1), 21.91, "Europe/Berlin UTC+1", 2019, 10)
    assert rows[4] == (T(2019, 10, 27, 3), T(2019, 10, 27, 2), 68.86, "Europe/Berlin UTC+1", 2019, 10)


def test_spring_forward_day(spark, session_tz):
    rows = _collect(to_long(make_wide(spark, [SPRING])))
    assert len(rows) == 23
    _assert_hourly(rows)
    assert rows[1] == (T(2019, 3, 31, 1), T(2019, 3, 31, 0), 88.85, "Europe/Berlin UTC+1", 2019, 3)
    assert rows[2] == (T(2019, 3, 31, 3), T(2019, 3, 31, 1), 73.68, "Europe/Berlin UTC+2", 2019, 3)


def test_three_days_in_one_frame_in_any_order(spark, session_tz):
    # The reference could only infer a repeated hour when it was the last row;
    # here the label decides, so the order of days does not matter.
    rows = _collect(to_long(make_wide(spark, [AUTUMN, NORMAL, SPRING])))
    assert len(rows) == 24 + 25 + 23
    offsets = {(r[0], r[3]) for r in rows if r[0].date() == dt.date(2019, 10, 27) and r[0].hour == 2}
    assert offsets == {(T(2019, 10, 27, 2), "Europe/Berlin UTC+2"), (T(2019, 10, 27, 2), "Europe/Berlin UTC+1")}


def test_output_schema(spark):
    out = to_long(make_wide(spark, [NORMAL]))
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields] == [
        ("timestamp", "timestamp_ntz"), ("timestamp_utc", "timestamp_ntz"), ("price", "double"),
        ("timezone", "string"), ("year", "int"), ("month", "int")]


def test_session_zone_change_day_is_irrelevant(spark):
    # 10 March 2024 is a change day in New York, not in Berlin.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        prices = [float(i) for i in range(1, 26)]
        prices[3] = None
        rows = _collect(to_long(make_wide(spark, [("10/03/2024", prices)])))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r[0].hour for r in rows] == list(range(24))
    _assert_hourly(rows)


@pytest.mark.parametrize("policy", ["drop", "quarantine"])
def test_sorted_output_is_stable(spark, policy):
    out = to_long(make_wide(spark, [SPRING, NORMAL]), on_nonexistent=policy).orderBy("timestamp_utc")
    assert out.count() == 47
    assert out.filter(F.col("price").isNull()).count() == 0
