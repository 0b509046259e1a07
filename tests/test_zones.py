"""Property check against Python's zoneinfo, for several zones: every local
hour of every day gets the right UTC instant, offset label, and only existing
hours appear; the repeated hour appears twice (first / second by label)."""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest

from pricetide import to_long

UTC = dt.timezone.utc


def _utc_of(local: dt.datetime, tz: ZoneInfo, fold: int) -> dt.datetime:
    return local.replace(tzinfo=tz, fold=fold).astimezone(UTC).replace(tzinfo=None)


def _exists(local: dt.datetime, tz: ZoneInfo) -> bool:
    aware = local.replace(tzinfo=tz)
    back = aware.astimezone(UTC).astimezone(tz).replace(tzinfo=None)
    return back == local


def _ambiguous(local: dt.datetime, tz: ZoneInfo) -> bool:
    return _utc_of(local, tz, 0) != _utc_of(local, tz, 1)


def _expected_and_wide(zone: str, repeated_slot: int, start: dt.date, days: int):
    tz = ZoneInfo(zone)
    slots = [f"hour_{i}" for i in range(1, 25)]
    second = f"hour_{repeated_slot}b"
    columns = ["delivery_day"] + slots[:repeated_slot] + [second] + slots[repeated_slot:]
    rows, expected = [], set()
    for n in range(days):
        day = start + dt.timedelta(days=n)
        base = day.toordinal() * 100
        values = {}
        for h in range(24):
            local = dt.datetime(day.year, day.month, day.day, h)
            price = float(base + h)
            if not _exists(local, tz):
                continue
            values[f"hour_{h + 1}"] = price
            utc = _utc_of(local, tz, 0)
            expected.add((local, utc, price, _label(zone, local, utc)))
            if _ambiguous(local, tz):
                assert h + 1 == repeated_slot, (zone, local)
                p2 = float(base + 50 + h)
                values[second] = p2
                utc2 = _utc_of(local, tz, 1)
                expected.add((local, utc2, p2, _label(zone, local, utc2)))
        rows.append(tuple([day] + [values.get(c) for c in columns[1:]]))
    ddl = ", ".join(["delivery_day date"] + [f"{c} double" for c in columns[1:]])
    return rows, ddl, expected


def _label(zone, local, utc):
    return f"{zone} UTC+{int((local - utc).total_seconds() // 3600) if local >= utc else -int((utc - local).total_seconds() // 3600)}"


@pytest.mark.parametrize("zone,repeated_slot", [
    ("Europe/Berlin", 3),      # 02:00 repeats
    ("America/New_York", 2),   # 01:00 repeats
    ("Europe/London", 2),      # 01:00 repeats
    ("Australia/Sydney", 3),   # 02:00 repeats, southern hemisphere
])
def test_matches_zoneinfo(spark, session_tz, zone, repeated_slot):
    rows, ddl, expected = _expected_and_wide(zone, repeated_slot, dt.date(2015, 1, 1), 11 * 365)
    wide = spark.createDataFrame(rows, ddl)
    got = {tuple(r) for r in to_long(wide, timezone=zone).select(
        "timestamp", "timestamp_utc", "price", "timezone").collect()}
    assert got == expected


@pytest.mark.parametrize("zone,repeated,day", [
    ("Antarctica/Troll", (2, 3), dt.date(2024, 10, 27)),      # two hours back: 01:00 and 02:00 repeat
    ("Antarctica/Troll", (), dt.date(2024, 3, 31)),           # two hours forward
    ("Australia/Lord_Howe", (), dt.date(2024, 4, 7)),         # half an hour back: no whole hour repeats
    ("Australia/Lord_Howe", (), dt.date(2024, 10, 6)),        # half an hour forward
    ("Atlantic/Azores", (1,), dt.date(2024, 10, 27)),         # 00:00 repeats: the day's first midnight counts
])
def test_changes_of_other_sizes(spark, session_tz, zone, repeated, day):
    """Every hour of the days around a change, repeated hours by their suffix."""
    tz, rows, expected = ZoneInfo(zone), [], set()
    slots = [f"hour_{i}" for i in range(1, 25)] + [f"hour_{i}b" for i in (1, 2, 3)]
    for n in (-1, 0, 1):
        date, values = day + dt.timedelta(days=n), {}
        for h in range(24):
            local = dt.datetime(date.year, date.month, date.day, h)
            if not _exists(local, tz):
                continue
            for fold, slot in ((0, f"hour_{h + 1}"), (1, f"hour_{h + 1}b")):
                if fold and not _ambiguous(local, tz):
                    continue
                assert not fold or (h + 1 in repeated and n == 0)
                values[slot] = float(100 * n + h + fold / 2)
                expected.add((local, _utc_of(local, tz, fold), values[slot]))
        rows.append((date, *[values.get(s) for s in slots]))
    wide = spark.createDataFrame(rows, ", ".join(["delivery_day date", *[f"{s} double" for s in slots]]))
    got = to_long(wide, timezone=zone, on_ambiguous="second").select("timestamp", "timestamp_utc", "price")
    without_suffix = {(a, b, c) for a, b, c in expected if c % 1 == 0 and not _ambiguous(a, tz)}
    assert {tuple(r) for r in got.collect()} >= without_suffix
    got = {tuple(r) for r in to_long(wide, timezone=zone).select("timestamp", "timestamp_utc", "price").collect()}
    assert got == expected
    if repeated:
        with pytest.raises(Exception, match="unresolved_ambiguous_time"):
            to_long(wide, timezone=zone, on_ambiguous="raise").collect()


def test_kinds_of_days(spark):
    from pricetide.operators.quality import dst_calendar

    days = spark.sql("SELECT explode(array(DATE'2024-04-07', DATE'2024-10-06', DATE'2024-05-01')) AS delivery_day")
    kinds = [r.day_kind for r in dst_calendar(days, "Australia/Lord_Howe").orderBy("delivery_day").collect()]
    assert kinds == ["irregular", "normal", "irregular"]
    troll = dst_calendar(spark.sql("SELECT DATE'2024-10-27' AS delivery_day"), "Antarctica/Troll").first()
    assert (troll.day_kind, troll.hours_in_day) == ("irregular", 26)
