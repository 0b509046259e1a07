"""The wide -> long transform with DST-correct local and UTC time.

Everything below is one narrow stage: Project -> Expand (unpivot) -> Filter ->
Project. No shuffle, no UDF; the time-zone work is ``convert_timezone`` on
TIMESTAMP_NTZ, so results do not depend on the session time zone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.functions.slots import parse_delivery_day
from pricetide.functions.tz import (
    is_ambiguous,
    is_nonexistent,
    local_to_utc_naive,
    utc_offset_hours,
    zone_label,
)
from pricetide.operators.reshape import lineage_columns, slot_columns, snake_case_columns
from pricetide.schema import DAY_COLUMN, DEFAULT_TIMEZONE, LONG_COLUMNS, NULL_MARKERS

_SLOT_NAME = re.compile(r"^hour_[0-9]+[a-z]?$")
# One pattern instead of a list test: a long IN list breaks code generation
# of this projection.
_NULL_PATTERN = "^(" + "|".join(re.escape(m) for m in NULL_MARKERS) + ")$"
_POLICIES = ("raise", "drop", "quarantine")

# Reasons a long row is rejected.
REJECT_BAD_DAY = "bad_delivery_day"
REJECT_BAD_PRICE = "bad_price"
REJECT_UNKNOWN_SLOT = "unknown_slot"
REJECT_NONEXISTENT = "nonexistent_local_time"
REJECT_AMBIGUOUS = "unresolved_ambiguous_time"
REJECT_MALFORMED = "malformed_line"
REJECT_UNKEYED = "unkeyed_file"


def normalise_wide(wide: DataFrame) -> DataFrame:
    """Snake-case names and check the header: a delivery day plus slot columns
    named ``hour_<n>[suffix]``. Anything else is refused before any data is
    read (the reference would unpivot it and fail later)."""
    df = snake_case_columns(wide)
    if DAY_COLUMN not in df.columns:
        raise ValueError(f"wide frame has no '{DAY_COLUMN}' column: {df.columns}")
    unknown = [c for c in slot_columns(df)
               if not _SLOT_NAME.match(c) or not 1 <= (_slot_number(c) or 0) <= 24]
    if unknown:
        raise ValueError(f"unexpected columns in wide price frame: {unknown}")
    return df


def annotate_long(wide: DataFrame, timezone: str = DEFAULT_TIMEZONE,
                  on_ambiguous: str = "first") -> DataFrame:
    """Long rows of every filled cell with their time and a ``reject_reason``.

    Columns: delivery_day, hour_name, hour, price, timestamp, timestamp_utc,
    utc_offset, timezone, year, month, is_ambiguous, is_nonexistent,
    reject_reason, plus lineage columns and, where the input is text,
    ``delivery_day_text`` and ``cell_text`` as they were.

    Ambiguous wall times (the hour a fall-back day repeats) are resolved by
    the slot label: suffix ``a`` = first occurrence (summer time), ``b`` =
    second (standard time). An ambiguous slot without suffix follows
    ``on_ambiguous``: ``first``, ``second`` or ``raise``.
    """
    if on_ambiguous not in ("first", "second", "raise"):
        raise ValueError(f"on_ambiguous must be first, second or raise, not {on_ambiguous!r}")
    # Few, wide projections: every DataFrame step re-analyses the plan, so
    # the expressions are composed here and applied in four selects.
    df = normalise_wide(wide)
    slots = slot_columns(df)
    lineage = lineage_columns(df)
    text_slots = any(isinstance(df.schema[c].dataType, T.StringType) for c in slots)
    day_type = df.schema[DAY_COLUMN].dataType

    if isinstance(day_type, T.StringType):
        day_text = F.trim(F.col(DAY_COLUMN))
        day = parse_delivery_day(day_text, strict=False)
        day_cols = [day.alias(DAY_COLUMN), day_text.alias("_day_text")]
        lineage = lineage + ["_day_text"]
    else:
        day = F.col(DAY_COLUMN) if isinstance(day_type, T.DateType) else F.col(DAY_COLUMN).cast("date")
        day_cols = [day.alias(DAY_COLUMN)]
    bad_day = F.col(DAY_COLUMN).isNull()  # unreadable or empty

    # Slot number and suffix come from the column names: known on the driver,
    # so they travel through the unpivot as literals instead of being parsed
    # from the label on every row.
    meta = [(c, _slot_number(c), _slot_letter(c)) for c in slots]

    # Per delivery day (before the unpivot, 25x fewer rows): the UTC instants
    # of the two local midnights. A day whose midnights are 24 h apart keeps
    # one offset all day, so every slot's UTC time is the first midnight's
    # plus the slot's hours; only the other days (two a year in a DST zone)
    # take the slot-by-slot path with its zone conversions.
    day_start = day.cast("timestamp_ntz")
    u0 = local_to_utc_naive(day_start, timezone)
    u1 = local_to_utc_naive(F.date_add(day, 1).cast("timestamp_ntz"), timezone)
    offset0 = utc_offset_hours(day_start, u0)
    # One explicit, nullable struct type for every slot: left to type
    # coercion, a slot built from a non-null literal would make the field
    # non-nullable and the null-price filter would be optimised away.
    # (One SQL snippet per slot keeps the driver's gateway calls few.)
    cell_type = "string" if text_slots else "double"
    slot_type = f"struct<v:{cell_type},hour:int,suffix:string>"
    values = [F.expr(f"CAST(named_struct('v', CAST(`{c}` AS {cell_type}), 'hour', {h}, 'suffix', '{x}') "
                     f"AS {slot_type}) AS `{c}`") for c, h, x in meta]
    per_day = df.select(
        *day_cols, *[c for c in lineage if c != "_day_text"], *values,
        day_start.alias("_day_start"), u0.alias("_u0"),
        F.coalesce((u1 - u0) == F.expr("INTERVAL '24' HOUR"), F.lit(False)).alias("_regular"),
        (u1 - u0 - F.expr("INTERVAL '24' HOUR")).alias("_change"),
        offset0.alias("_offset0"), zone_label(timezone, offset0).alias("_label0"),
        # Slots 1..24 lie on the delivery day: local year / month are the day's.
        F.year(day).alias("year"), F.month(day).alias("month"),
    )
    ids = [DAY_COLUMN, *lineage, "_day_start", "_u0", "_regular", "_change", "_offset0", "_label0", "year", "month"]
    long = per_day.unpivot(ids, slots, "hour_name", "_slot")

    if text_slots:
        # Cells arrive as text, so each bad number is caught per cell.
        cell_text = F.trim(F.col("_slot.v"))
        cell_text = F.when(~cell_text.rlike(_NULL_PATTERN), cell_text)
        price = cell_text.try_cast("double")
        filled = cell_text.isNotNull() & ~(price.isNotNull() & F.isnan(price))
        bad_price = cell_text.isNotNull() & price.isNull()
    else:
        cell_text = None
        price = F.col("_slot.v")
        filled = price.isNotNull() & ~F.isnan(price)
        bad_price = F.lit(False)

    step = F.make_dt_interval(F.lit(0), F.col("hour") - 1)
    regular = F.col("_regular")
    long = long.filter(filled).select(
        *ids, "hour_name", price.alias("price"), F.col("_slot.hour").alias("hour"),
        F.col("_slot.suffix").alias("_suffix"), bad_day.alias("_bad_day"), bad_price.alias("_bad_price"),
        filled.alias("_filled"), *([] if cell_text is None else [cell_text.alias("_cell_text")]))
    # Irregular days only: the slot-by-slot conversion (inside CASE branches,
    # so regular days never evaluate it).
    local = F.col("_day_start") + step
    u = local_to_utc_naive(local, timezone)
    nonexistent = F.when(regular, F.lit(False)).otherwise(
        F.coalesce(is_nonexistent(local, timezone, u), F.lit(False)))
    ambiguous = F.when(regular, F.lit(False)).otherwise(
        F.coalesce(is_ambiguous(local, timezone, u, F.col("_change")), F.lit(False)))
    long = long.select("*", local.alias("timestamp"), nonexistent.alias("is_nonexistent"),
                       ambiguous.alias("is_ambiguous"))

    take_second = F.col("_suffix") == "b"
    unresolved = F.col("is_ambiguous") & ~F.col("_suffix").isin("a", "b")
    if on_ambiguous == "second":
        take_second = take_second | unresolved
    u = local_to_utc_naive("timestamp", timezone)
    utc = (F.when(regular, F.col("_u0") + step)
            .when(F.col("is_ambiguous") & take_second, u + F.col("_change"))
            .otherwise(u))
    offset = F.when(regular, F.col("_offset0")).otherwise(utc_offset_hours(F.col("timestamp"), utc))
    label = F.when(regular, F.col("_label0")).otherwise(zone_label(timezone, offset))
    # ``_filled`` is always true here; it keeps the reason null for an empty
    # cell even where the optimiser evaluates a policy check (which may
    # raise) next to, rather than after, the filled-cell filter.
    reason = (F.when(~F.col("_filled"), F.lit(None).cast("string"))
               .when(F.col("_bad_day"), F.lit(REJECT_BAD_DAY))
               .when(F.col("_bad_price"), F.lit(REJECT_BAD_PRICE))
               .when(F.col("hour").isNull(), F.lit(REJECT_UNKNOWN_SLOT))
               .when(F.col("is_nonexistent"), F.lit(REJECT_NONEXISTENT)))
    if on_ambiguous == "raise":
        reason = reason.when(unresolved, F.lit(REJECT_AMBIGUOUS))
    keep = [DAY_COLUMN, "hour_name", "hour", "price", "timestamp", utc.alias("timestamp_utc"),
            offset.alias("utc_offset"), label.alias("timezone"), "year", "month",
            "is_ambiguous", "is_nonexistent", reason.alias("reject_reason")]
    keep += [c for c in lineage if c != "_day_text"]
    if "_day_text" in lineage:
        keep.append(F.col("_day_text").alias("delivery_day_text"))
    if text_slots:
        keep.append(F.col("_cell_text").alias("cell_text"))
    return long.select(*keep)


def _slot_number(name: str) -> int | None:
    m = re.search(r"([0-9]+)", name)
    return int(m.group(1)) if m else None


def _slot_letter(name: str) -> str:
    m = re.search(r"[0-9]+([A-Za-z]*)$", name)
    return m.group(1).lower() if m else ""


def with_zone_columns(long: DataFrame, timezone: str = DEFAULT_TIMEZONE) -> DataFrame:
    """Add UTC offset label and local year / month.

    Keeps the columns :func:`annotate_long` already computed."""
    if {"timezone", "year", "month"} <= set(long.columns):
        return long
    if "utc_offset" in long.columns:
        offset = F.col("utc_offset")
    else:
        offset = utc_offset_hours("timestamp", "timestamp_utc")
    return long.withColumns({
        "timezone": zone_label(timezone, offset),
        "year": F.year("timestamp"),
        "month": F.month("timestamp"),
    })


def _check_policy(policy: str) -> None:
    if policy not in _POLICIES:
        raise ValueError(f"policy must be one of {_POLICIES}, not {policy!r}")


def to_long(wide: DataFrame, timezone: str = DEFAULT_TIMEZONE, on_nonexistent: str = "raise",
            on_invalid: str = "raise", on_ambiguous: str = "first",
            keep_columns: list[str] | None = None) -> DataFrame:
    """Wide price frame -> long table ``timestamp, timestamp_utc, price,
    timezone, year, month`` (X1).

    ``on_nonexistent`` handles a *priced* slot whose wall time is skipped
    (spring day with 3A/3B set); ``on_invalid`` a malformed date, price or
    slot name. Each is ``raise`` (default), ``drop`` or ``quarantine``;
    quarantined rows are left out here and returned by :func:`rejected_rows`.
    ``keep_columns`` appends extra columns (e.g. lineage) after the six.
    """
    long = annotate_long(wide, timezone, on_ambiguous)
    return finish_long(long, timezone, on_nonexistent, on_invalid, keep_columns)


def finish_long(annotated: DataFrame, timezone: str = DEFAULT_TIMEZONE, on_nonexistent: str = "raise",
                on_invalid: str = "raise", keep_columns: list[str] | None = None) -> DataFrame:
    """Policy + final projection on the output of :func:`annotate_long`."""
    _check_policy(on_nonexistent)
    _check_policy(on_invalid)
    invalid = [REJECT_BAD_DAY, REJECT_BAD_PRICE, REJECT_UNKNOWN_SLOT, REJECT_AMBIGUOUS]
    policy = {r: on_invalid for r in invalid}
    policy[REJECT_NONEXISTENT] = on_nonexistent
    raising = [r for r, p in policy.items() if p == "raise"]
    leaving = [r for r, p in policy.items() if p != "raise"]
    long = with_zone_columns(annotated, timezone)
    if leaving:
        long = long.filter(~F.coalesce(F.col("reject_reason").isin(leaving), F.lit(False)))
    if raising:
        # Fail fast in the task that meets the row, with the row in the
        # message. A filter, not a projection: column pruning (e.g. under a
        # count) cannot remove the check.
        msg = F.concat(F.lit("rejected price cell ("), F.col("reject_reason"), F.lit("): day "),
                       F.coalesce(F.col(DAY_COLUMN).cast("string"), F.lit("?")), F.lit(" slot "),
                       F.col("hour_name"))
        long = long.filter(F.when(F.col("reject_reason").isin(raising), F.raise_error(msg))
                            .otherwise(F.lit(True)))
    return long.select(*LONG_COLUMNS, *(keep_columns or []))


def rejected_rows(annotated: DataFrame) -> DataFrame:
    """Rows of :func:`annotate_long` that a policy would refuse."""
    return annotated.filter(F.col("reject_reason").isNotNull())


def long_with_nulls(wide: DataFrame) -> DataFrame:
    """Plain unpivot of every slot, empty cells kept (P2 with ``INCLUDE NULLS``)."""
    df = normalise_wide(wide)
    slots = slot_columns(df)
    ids = [DAY_COLUMN] + lineage_columns(df)
    df = df.select(*ids, *[F.expr(f"try_cast(`{c}` AS double) AS `{c}`") for c in slots])
    return df.unpivot(ids, slots, "hour_name", "price")

