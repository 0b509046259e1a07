"""Time-zone expressions on TIMESTAMP_NTZ.

Everything stays on wall-clock values without zone and goes through
``convert_timezone``, so results never depend on the session time zone.
``convert_timezone(tz, 'UTC', t)`` maps an ambiguous wall time to its *first*
instant and moves a skipped wall time forward; the tests below turn both
silent choices into explicit flags.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



# Names of the three day kinds by their length in hours.
DAY_KINDS = {23: "spring_forward", 24: "normal", 25: "fall_back"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_to_utc_naive(local: Column | str, tz: str) -> Column:
    """First UTC instant of a local wall time."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _col(local))


def utc_to_local(utc: Column | str, tz: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _col(utc))


def is_nonexistent(local: Column | str, tz: str, utc_first: Column | None = None) -> Column:
    """True when the wall time is skipped by a spring-forward change."""
    u = local_to_utc_naive(local, tz) if utc_first is None else utc_first
    return utc_to_local(u, tz) != _col(local)


def day_length(day: Column | str, tz: str) -> Column:
    """Time between a local calendar day's two midnights, as an interval."""
    start = _col(day).cast("timestamp_ntz")
    end = F.date_add(_col(day), 1).cast("timestamp_ntz")
    return local_to_utc_naive(end, tz) - local_to_utc_naive(start, tz)


def clock_change(local: Column | str, tz: str) -> Column:
    """How far the clocks go back on the local day of a wall time, by the
    offsets at its two midnights: an hour in most zones, half an hour or two in
    some, negative where they go forward, zero on other days."""
    return day_length(_col(local).cast("date"), tz) - F.expr("INTERVAL '24' HOUR")


def is_ambiguous(local: Column | str, tz: str, utc_first: Column | None = None,
                 change: Column | None = None) -> Column:
    """True when the wall time occurs twice on a fall-back day (C6): the same
    wall time is met again as much later as the clocks go back."""
    u = local_to_utc_naive(local, tz) if utc_first is None else utc_first
    change = clock_change(local, tz) if change is None else change
    return (change > F.expr("INTERVAL '0' HOUR")) & (utc_to_local(u + change, tz) == _col(local))


def utc_offset_hours(local: Column | str, utc: Column | str) -> Column:
    """Whole hours between wall time and UTC, truncated toward zero."""
    return (_col(local) - _col(utc)).cast("interval hour").cast("int")


def zone_label(tz: str, offset_hours: Column) -> Column:
    """``Europe/Berlin UTC+2``; a negative offset prints as ``UTC+-5`` (C11)."""
    return F.concat(F.lit(f"{tz} UTC+"), offset_hours.cast("string"))


def hours_in_day(day: Column | str, tz: str) -> Column:
    """Length of a local calendar day in hours: 23, 24 or 25 (C12); half hours
    are cut off."""
    return day_length(day, tz).cast("interval hour").cast("int")


def seconds_in_day(day: Column | str, tz: str) -> Column:
    return day_length(day, tz).cast("interval second").cast("int")


def day_kind(day: Column | str, tz: str) -> Column:
    """``spring_forward`` / ``normal`` / ``fall_back`` from the day's exact
    length, ``irregular`` for any other (changes of half an hour or two)."""
    seconds, expr = seconds_in_day(day, tz), F
    for n, name in sorted(DAY_KINDS.items()):
        expr = expr.when(seconds == n * 3600, F.lit(name))
    return F.when(seconds.isNotNull(), expr.otherwise(F.lit("irregular")))
