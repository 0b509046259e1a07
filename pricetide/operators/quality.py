"""Data-quality checks on the wide and long tables.

Every check first aggregates per (day[, hour]) with map-side partial
aggregation, so a day with many duplicate copies costs one row per task
before any shuffle; windows then run over at most 25 distinct hours per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.functions.tz import day_kind, hours_in_day
from pricetide.operators.long import long_with_nulls, normalise_wide
from pricetide.operators.reshape import type_delivery_day, type_slots
from pricetide.schema import DAY_COLUMN, DEFAULT_TIMEZONE

# Violation names of the slot pattern check.
VIOLATION_3B_ON_NORMAL_DAY = "hour_3b_priced_on_normal_day"
VIOLATION_3A_MISSING = "hour_3a_missing_on_normal_day"
VIOLATION_SKIPPED_HOUR_PRICED = "skipped_hour_priced"
VIOLATION_REPEATED_HOUR_MISSING = "repeated_hour_missing"

EXPECTED_STEP_SECONDS = 3600


def typed_wide(wide: DataFrame) -> DataFrame:
    """Snake-case, DATE delivery day (malformed -> null) and DOUBLE slots."""
    return type_slots(type_delivery_day(normalise_wide(wide), strict=False))


def day_spine(wide: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last delivery day, so that
    days missing from the data show up. Its size is the date span, not the
    data volume."""
    df = typed_wide(wide)
    return calendar_days(df.agg(F.min(DAY_COLUMN).alias("first"), F.max(DAY_COLUMN).alias("last")))


def dst_calendar(days: DataFrame, timezone: str = DEFAULT_TIMEZONE) -> DataFrame:
    """Per day: ``hours_in_day`` (23 / 24 / 25) and ``day_kind``.

    Derived from the zone rules of each year (Berlin's summer time ended in
    September before 1996); a day of any other length is ``irregular``."""
    hours = hours_in_day(DAY_COLUMN, timezone)
    return (days.select(DAY_COLUMN).distinct()
                .withColumn("hours_in_day", hours)
                .withColumn("day_kind", day_kind(DAY_COLUMN, timezone)))


def slot_pattern_violations(wide: DataFrame, timezone: str = DEFAULT_TIMEZONE) -> DataFrame:
    """Wide rows whose 3A / 3B cells do not fit the day (C13): a normal day
    has 3A and no 3B, a spring-forward day neither, a fall-back day both.
    Narrow: one check per row, no shuffle."""
    df = typed_wide(wide)
    a_set = F.col("hour_3a").isNotNull() & ~F.isnan("hour_3a")
    b_set = F.col("hour_3b").isNotNull() & ~F.isnan("hour_3b")
    kind = day_kind(DAY_COLUMN, timezone)
    checked = df.select(DAY_COLUMN, kind.alias("day_kind"),
                        a_set.alias("hour_3a_set"), b_set.alias("hour_3b_set"))
    violation = _violation(F.col("day_kind"), F.col("hour_3a_set"), F.col("hour_3b_set"))
    return checked.withColumn("violation", violation).filter(F.col("violation").isNotNull())


def _violation(kind: Column, a_set: Column, b_set: Column) -> Column:
    return (F.when((kind == "normal") & b_set, VIOLATION_3B_ON_NORMAL_DAY)
             .when((kind == "normal") & ~a_set, VIOLATION_3A_MISSING)
             .when((kind == "spring_forward") & (a_set | b_set), VIOLATION_SKIPPED_HOUR_PRICED)
             .when((kind == "fall_back") & ~(a_set & b_set), VIOLATION_REPEATED_HOUR_MISSING))


def all_null(value: Column, where: Column | None = None) -> Column:
    """``true`` when every value (of the rows matching ``where``) is null or
    NaN; an empty set counts as all-null (A1)."""
    missing = value.isNull() | F.isnan(value)
    if where is not None:
        missing = F.when(where, missing)
    return F.coalesce(F.bool_and(missing), F.lit(True))


def dst_slots_all_null(wide: DataFrame, slots: tuple[str, ...] = ("hour_3a", "hour_3b")) -> DataFrame:
    """Per delivery day: are the DST slots all empty? (A1)"""
    long = long_with_nulls(wide)
    return (long.groupBy(DAY_COLUMN)
                .agg(all_null(F.col("price"), F.col("hour_name").isin(*slots)).alias("dst_slots_all_null")))


def _hour_counts(long: DataFrame) -> DataFrame:
    """Rows per (local day, UTC hour): partial aggregation first."""
    return (long.groupBy(F.col("timestamp").cast("date").alias(DAY_COLUMN), "timestamp_utc")
                .agg(F.count(F.lit(1)).alias("n_rows")))


def _last_hours(hour_counts: DataFrame) -> DataFrame:
    """Per day with an hour: the last hour of the last day before it that has
    one. Days are windowed within their year; what a year's first day takes over
    is carried from the years before it, a table of one row a year, so no window
    runs over all days."""
    days = hour_counts.groupBy(DAY_COLUMN).agg(F.max("timestamp_utc").alias("_last"))
    days = days.withColumn("_year", F.year(DAY_COLUMN))
    years = days.groupBy("_year").agg(F.max(F.struct(DAY_COLUMN, "_last")).alias("_end"))
    before = Window.orderBy("_year")  # one row per calendar year
    carried = years.select("_year", F.lag("_end").over(before)["_last"].alias("_carried"))
    w = Window.partitionBy("_year").orderBy(DAY_COLUMN)
    return (days.withColumn("_before", F.lag("_last").over(w)).join(carried, "_year")
                .select(DAY_COLUMN, F.coalesce("_before", "_carried").alias("_last")))


def _with_steps(hour_counts: DataFrame) -> DataFrame:
    """Every UTC hour with the one before it: within the day by a window of at
    most 25 hours, across midnight and any missing days by the last hour of the
    last day that has one, a table of one row per day."""
    w = Window.partitionBy(DAY_COLUMN).orderBy("timestamp_utc")
    prev = F.coalesce(F.lag("timestamp_utc").over(w), F.col("_last"))
    return (hour_counts.join(_last_hours(hour_counts), DAY_COLUMN, "left")
                       .withColumn("prev_timestamp_utc", prev).drop("_last")
                       .withColumn("step_seconds",
                                   (F.col("timestamp_utc") - F.col("prev_timestamp_utc"))
                                   .cast("interval second").cast("bigint")))


def utc_hour_gaps(long: DataFrame) -> DataFrame:
    """UTC hours that do not follow the previous one by exactly one hour (W1),
    also across midnight and missing days: ``n_rows > 1`` is a duplicate hour,
    ``step_seconds`` above 3600 a gap, however many days it spans."""
    steps = _with_steps(_hour_counts(long))
    bad = (F.col("prev_timestamp_utc").isNotNull() & (F.col("step_seconds") != EXPECTED_STEP_SECONDS)) | (
        F.col("n_rows") > 1)
    return steps.filter(bad).select(DAY_COLUMN, "timestamp_utc", "prev_timestamp_utc", "step_seconds", "n_rows")


def completeness_status(n_hours: Column, expected: Column) -> Column:
    return (F.when(n_hours.isNull() | (n_hours == 0), "missing")
             .when(n_hours < expected, "incomplete")
             .when(n_hours > expected, "excess")
             .otherwise("complete"))


def calendar_days(bounds: DataFrame) -> DataFrame:
    """Every calendar day from ``first`` to ``last`` of a one-row frame, exploded
    year by year, so that tasks share a long span."""
    years = bounds.select("first", "last", F.explode(F.sequence(F.year("first"), F.year("last"))).alias("_year"))
    start = F.greatest("first", F.make_date("_year", F.lit(1), F.lit(1)))
    end = F.least("last", F.make_date("_year", F.lit(12), F.lit(31)))
    return years.select(F.explode(F.sequence(start, end)).alias(DAY_COLUMN))


def day_completeness(long: DataFrame, timezone: str = DEFAULT_TIMEZONE, first: str | None = None,
                     last: str | None = None) -> DataFrame:
    """Rows per local day against the day's length in hours (A2), one row for
    every calendar day between the table's first and last (or the dates
    given): a day without any row is ``missing``. Rows without a time make one
    row with a null day."""
    per_day = (long.groupBy(F.col("timestamp").cast("date").alias(DAY_COLUMN))
                   .agg(F.count(F.lit(1)).alias("n_hours")))
    bounds = per_day.agg(F.min(DAY_COLUMN).alias("first"), F.max(DAY_COLUMN).alias("last"))
    if first is not None:
        bounds = bounds.withColumn("first", F.lit(first).cast("date"))
    if last is not None:
        bounds = bounds.withColumn("last", F.lit(last).cast("date"))
    days = calendar_days(bounds.filter("first <= last"))
    known = per_day.filter(F.col(DAY_COLUMN).isNotNull())
    found = days.join(known, DAY_COLUMN, "left").select(DAY_COLUMN, F.coalesce("n_hours", F.lit(0)).alias("n_hours"))
    found = found.unionByName(per_day.filter(F.col(DAY_COLUMN).isNull()))
    expected = hours_in_day(DAY_COLUMN, timezone)
    return (found.withColumn("expected_hours", expected)
                 .withColumn("status", F.when(F.col(DAY_COLUMN).isNotNull(), completeness_status(
                     F.col("n_hours"), F.col("expected_hours"))).otherwise("no_time")))


def quality_report(wide: DataFrame, long: DataFrame, timezone: str = DEFAULT_TIMEZONE) -> DataFrame:
    """One row per calendar day of the data's span, and one with a null day if
    rows have an unreadable day (X3): expected hours and day kind, wide rows seen, long hours written, duplicate hours, irregular
    UTC steps, slot-pattern violation and an overall ``status``.

    All inputs are reduced to one row per day before they meet, so the joins
    are between small per-day tables (AQE broadcasts them when measured
    small)."""
    # Wide side in one aggregation: rows and first violation per day; the
    # spine's bounds come from the same per-day table. When the wide input is
    # costly to produce, checkpoint it first (it is one row per day and file):
    # the wide side, the spine and the long side then read it, not its source.
    wide_n = typed_wide(wide)
    a_set = F.col("hour_3a").isNotNull() & ~F.isnan("hour_3a")
    b_set = F.col("hour_3b").isNotNull() & ~F.isnan("hour_3b")
    kind = day_kind(DAY_COLUMN, timezone)
    per_day = (wide_n.select(DAY_COLUMN, _violation(kind, a_set, b_set).alias("violation"))
                     .groupBy(DAY_COLUMN)
                     .agg(F.count(F.lit(1)).alias("n_wide_rows"), F.min("violation").alias("violation")))
    spine = calendar_days(per_day.agg(F.min(DAY_COLUMN).alias("first"), F.max(DAY_COLUMN).alias("last")))
    calendar = dst_calendar(spine, timezone)
    steps = _with_steps(_hour_counts(long))
    long_days = (steps.groupBy(DAY_COLUMN)
                      .agg(F.sum("n_rows").alias("n_hours"),
                           F.sum(F.col("n_rows") - 1).alias("n_duplicate_hours"),
                           F.count(F.when(F.col("prev_timestamp_utc").isNotNull()
                                          & (F.col("step_seconds") != EXPECTED_STEP_SECONDS), 1))
                            .alias("n_irregular_steps")))
    report = (calendar.join(per_day, DAY_COLUMN, "left")
                      .join(long_days, DAY_COLUMN, "left")
                      .fillna(0, subset=["n_wide_rows", "n_hours", "n_duplicate_hours", "n_irregular_steps"]))
    status = (F.when(F.col("n_wide_rows") == 0, "missing_day")
               .when(F.col("violation").isNotNull(), "slot_pattern")
               .when(F.col("n_duplicate_hours") > 0, "duplicate_hours")
               .when(F.col("n_irregular_steps") > 0, "irregular_steps")
               .when(F.col("n_hours") != F.col("hours_in_day"), completeness_status(F.col("n_hours"),
                                                                                   F.col("hours_in_day")))
               .otherwise("ok"))
    columns = [DAY_COLUMN, "day_kind", "hours_in_day", "n_wide_rows", "n_hours", "n_duplicate_hours",
               "n_irregular_steps", "violation", "status"]
    none, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")
    unreadable = per_day.filter(F.col(DAY_COLUMN).isNull()).select(
        DAY_COLUMN, none.alias("day_kind"), F.lit(None).cast("int").alias("hours_in_day"), "n_wide_rows",
        zero.alias("n_hours"), zero.alias("n_duplicate_hours"), zero.alias("n_irregular_steps"),
        none.alias("violation"), F.lit("unreadable_day").alias("status"))
    return report.withColumn("status", status).select(columns).unionByName(unreadable.select(columns))
