"""Slot label and delivery-day expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricetide.schema import DAY_PARSE_FORMAT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def slot_hour(label: Column | str) -> Column:
    """First digit run of the slot label as int (``hour_3a`` -> 3).

    No digits gives null (``try_cast``), so a stray column never raises here.
    """
    return F.regexp_extract(_col(label), r"([0-9]+)", 1).try_cast("int")


def parse_delivery_day(day: Column | str, strict: bool = True, fmt: str = DAY_PARSE_FORMAT) -> Column:
    """Day-first text (``31/03/2019``, also ``1/5/2024``) to DATE.

    ``strict`` raises on a malformed value (ANSI); otherwise the value becomes
    null so the row can go to quarantine.
    """
    day = _col(day)
    return F.to_date(day, fmt) if strict else F.try_to_date(day, fmt)


def day_start(day: Column | str) -> Column:
    """Local midnight of a DATE as wall time without zone."""
    return _col(day).cast("timestamp_ntz")


def slot_local_timestamp(day: Column | str, hour: Column | str) -> Column:
    """Local wall time of a slot: day start + (slot number - 1) hours."""
    return F.timestamp_add("HOUR", _col(hour) - 1, day_start(day))
