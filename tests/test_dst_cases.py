"""Cases the reference does not test (FIXTURES F5), month files and a
property check over four decades of days."""

import calendar
import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricetide import to_long
from pricetide.operators.long import annotate_long, rejected_rows
from pricetide.operators.quality import (
    day_completeness,
    dst_calendar,
    quality_report,
    slot_pattern_violations,
    utc_hour_gaps,
)
from pricetide.schema import DAY_COLUMN, SLOT_HEADERS
from tests.conftest import make_wide

T = dt.datetime
A, B = SLOT_HEADERS.index("Hour 3A"), SLOT_HEADERS.index("Hour 3B")

# Last Sundays of March and October in Berlin, 2018-2024.
SPRING_DAYS = {2018: 25, 2019: 31, 2020: 29, 2021: 28, 2022: 27, 2023: 26, 2024: 31}
AUTUMN_DAYS = {2018: 28, 2019: 27, 2020: 25, 2021: 31, 2022: 30, 2023: 29, 2024: 27}


def _prices(seed, a=True, b=False):
    p = [round((seed * 31 + i * 7) % 10000 / 100.0, 2) for i in range(25)]
    if not a:
        p[A] = None
    if not b:
        p[B] = None
    return p


def _month(year, month, spring=None, autumn=None):
    rows = []
    for d in range(1, calendar.monthrange(year, month)[1] + 1):
        day = f"{d:02d}/{month:02d}/{year}"
        if d == spring:
            rows.append((day, _prices(d, a=False, b=False)))
        elif d == autumn:
            rows.append((day, _prices(d, a=True, b=True)))
        else:
            rows.append((day, _prices(d)))
    return rows


@pytest.mark.parametrize("year", sorted(AUTUMN_DAYS))
def test_whole_october_file(spark, year):
    long = to_long(make_wide(spark, _month(year, 10, autumn=AUTUMN_DAYS[year])))
    assert long.count() == 31 * 24 + 1
    assert utc_hour_gaps(long).count() == 0


@pytest.mark.parametrize("year", sorted(SPRING_DAYS))
def test_whole_march_file(spark, year):
    long = to_long(make_wide(spark, _month(year, 3, spring=SPRING_DAYS[year])))
    assert long.count() == 31 * 24 - 1
    assert utc_hour_gaps(long).count() == 0


def test_year_border(spark):
    row = to_long(make_wide(spark, [("01/01/2024", _prices(1))])).orderBy("timestamp").first()
    assert (row.timestamp, row.timestamp_utc, row.year, row.month) == (T(2024, 1, 1), T(2023, 12, 31, 23), 2024, 1)


@pytest.mark.parametrize("slot,offset", [(A, "UTC+2"), (B, "UTC+1")])
def test_fall_back_day_with_one_repeated_hour(spark, slot, offset):
    p = _prices(5, a=True, b=True)
    p[B if slot == A else A] = None
    long = to_long(make_wide(spark, [("27/10/2024", p)]))
    assert long.count() == 24
    at2 = long.filter(F.hour("timestamp") == 2).first()
    assert at2.timezone.endswith(offset)
    # The other 02:00 is missing: one two-hour step in UTC.
    assert [g.step_seconds for g in utc_hour_gaps(long).collect()] == [7200]


def test_spring_day_with_priced_skipped_hour(spark):
    wide = make_wide(spark, [("31/03/2024", _prices(3, a=True))])
    with pytest.raises(Exception, match="nonexistent_local_time"):
        to_long(wide).collect()
    assert to_long(wide, on_nonexistent="drop").count() == 23
    assert to_long(wide, on_nonexistent="quarantine").count() == 23
    bad = rejected_rows(annotate_long(wide)).collect()
    assert [(r.hour_name, r.reject_reason) for r in bad] == [("hour_3a", "nonexistent_local_time")]


def test_normal_day_with_priced_3b_is_kept_and_reported(spark):
    wide = make_wide(spark, [("15/05/2024", _prices(4, a=True, b=True))])
    long = to_long(wide)
    assert long.count() == 25
    gaps = utc_hour_gaps(long).collect()
    assert [(g.timestamp_utc, g.n_rows) for g in gaps] == [(T(2024, 5, 15, 0), 2)]
    v = slot_pattern_violations(wide).collect()
    assert [r.violation for r in v] == ["hour_3b_priced_on_normal_day"]


def test_missing_slot_is_incomplete(spark):
    p = _prices(6)
    p[SLOT_HEADERS.index("Hour 5")] = None
    wide = make_wide(spark, [("16/05/2024", p)])
    long = to_long(wide)
    assert long.count() == 23
    c = day_completeness(long).first()
    assert (c.n_hours, c.expected_hours, c.status) == (23, 24, "incomplete")
    g = utc_hour_gaps(long).first()
    assert g.step_seconds == 7200


def test_old_rule_autumn_day_1995(spark):
    # Summer time ended on 24 September 1995, not in October.
    wide = make_wide(spark, [("24/09/1995", _prices(7, a=True, b=True)),
                             ("29/10/1995", _prices(8, a=True))])
    assert to_long(wide).count() == 25 + 24
    cal = {r[DAY_COLUMN].isoformat(): r.hours_in_day
           for r in dst_calendar(spark.createDataFrame(
               [(dt.date(1995, 9, 24),), (dt.date(1995, 10, 29),)], f"{DAY_COLUMN} date")).collect()}
    assert cal == {"1995-09-24": 25, "1995-10-29": 24}


def test_bad_date_and_bad_price(spark):
    text = spark.createDataFrame(
        [tuple(["32/01/2024"] + ["1.5"] * 25), tuple(["02/01/2024", "abc"] + ["2.5"] * 24)],
        ", ".join([f"`{c}` string" for c in ["Delivery day"] + SLOT_HEADERS]))
    with pytest.raises(Exception, match="bad_"):
        to_long(text).collect()
    reasons = sorted({r.reject_reason for r in rejected_rows(annotate_long(text)).collect()})
    assert reasons == ["bad_delivery_day", "bad_price"]
    good = to_long(text, on_invalid="quarantine")
    assert good.count() == 24  # second day: hour 1 bad; 2, 3A, 3B, 4..24 kept


def test_extra_column_is_refused(spark):
    wide = make_wide(spark, [("01/05/2024", _prices(1))]).withColumn("Comment", F.lit("x"))
    with pytest.raises(ValueError, match="comment"):
        to_long(wide)


def test_every_day_1990_to_2030_has_its_hours(spark, session_tz):
    days = spark.sql("SELECT explode(sequence(DATE'1990-01-01', DATE'2030-12-31')) AS d")
    cal = dst_calendar(days.withColumnRenamed("d", DAY_COLUMN))
    kinds = {r.day_kind: r.n for r in cal.groupBy("day_kind").agg(F.count("*").alias("n")).collect()}
    assert kinds["spring_forward"] == 41 and kinds["fall_back"] == 41
    # Fill every slot the day has and check the long table hour by hour.
    cols = [F.date_format(DAY_COLUMN, "dd/MM/yyyy").alias("Delivery day")]
    for i, h in enumerate(SLOT_HEADERS):
        v = F.lit(float(i))
        if h == "Hour 3A":
            v = F.when(F.col("day_kind") != "spring_forward", v)
        elif h == "Hour 3B":
            v = F.when(F.col("day_kind") == "fall_back", v)
        cols.append(v.cast("double").alias(h))
    wide = cal.select(*cols)
    long = to_long(wide)
    report = quality_report(wide, long)
    bad = report.filter(F.col("status") != "ok").count()
    assert bad == 0
    assert long.count() == 24 * cal.count() - 41 + 41


def test_unpadded_day_is_read(spark):
    long = to_long(make_wide(spark, [("1/5/2024", _prices(2))]))
    assert long.count() == 24
    assert long.agg(F.min("timestamp")).first()[0] == T(2024, 5, 1)


def test_hot_day_holding_a_third_of_rows(spark):
    # 200 copies of one day next to 400 distinct days: nothing is dropped,
    # the checks count every copy.
    base = dt.date(2020, 1, 1)
    days = [((base + dt.timedelta(days=i)).strftime("%d/%m/%Y"), _prices(i)) for i in range(400)]
    hot = [("15/06/2020", _prices(999))] * 200
    wide = make_wide(spark, days + hot).repartition(8)
    with pytest.raises(Exception, match="nonexistent_local_time"):
        to_long(wide).count()  # the priced 02:00 of 29 March 2020, even under a count
    long = to_long(wide, on_nonexistent="drop")
    assert long.count() == (400 + 200) * 24 - 1
    report = {r[DAY_COLUMN]: r for r in quality_report(wide, long).collect()}
    hot_day = report[dt.date(2020, 6, 15)]
    assert (hot_day.n_wide_rows, hot_day.n_hours, hot_day.n_duplicate_hours) == (201, 201 * 24, 200 * 24)
    assert hot_day.status == "duplicate_hours"
    assert report[dt.date(2020, 3, 29)].violation == "skipped_hour_priced"
    assert report[dt.date(2020, 10, 25)].violation == "repeated_hour_missing"
    assert sum(1 for r in report.values() if r.status == "ok") == 400 - 3


@pytest.mark.parametrize("policy,utc_hour", [("first", 0), ("second", 1)])
def test_repeated_hour_without_suffix_follows_policy(spark, policy, utc_hour):
    cols = ", ".join(["delivery_day string"] + [f"hour_{i} double" for i in range(1, 25)])
    wide = spark.createDataFrame([tuple(["27/10/2019"] + [float(i) for i in range(1, 25)])], cols)
    row = to_long(wide, on_ambiguous=policy).filter("price = 3.0").first()
    assert (row.timestamp, row.timestamp_utc) == (T(2019, 10, 27, 2), T(2019, 10, 27, utc_hour))


def test_repeated_hour_without_suffix_can_raise(spark):
    cols = ", ".join(["delivery_day string"] + [f"hour_{i} double" for i in range(1, 25)])
    wide = spark.createDataFrame([tuple(["27/10/2019"] + [float(i) for i in range(1, 25)])], cols)
    with pytest.raises(Exception, match="unresolved_ambiguous_time"):
        to_long(wide, on_ambiguous="raise").count()
    assert to_long(wide, on_ambiguous="raise", on_invalid="drop").count() == 23
