"""DuckDB SQL for every registered query (the correctness oracle).

The SQL re-derives the wide frame from ``lineitem`` and re-implements the
time-zone rules with DuckDB's ``timezone()``. DuckDB maps an ambiguous wall
time to its *later* instant (Spark: the earlier), so the SQL tests for
ambiguity itself and never compares raw conversions.
"""

from __future__ import annotations

from pricetide.queries import EMPTIED_MONTH, LOCAL_RANGE, OVERWRITE_LAST_MONTH, UTC_RANGE
from pricetide.schema import DEFAULT_TIMEZONE, SLOT_COLUMNS

TZ = DEFAULT_TIMEZONE


def _q(name: str) -> str:
    return '"' + name + '"'


_SLOT_LIST = ", ".join(SLOT_COLUMNS)

_CELLS = (
    "cells AS (SELECT CAST(l_shipdate AS DATE) AS d, "
    f"CAST((l_orderkey + l_linenumber) % {len(SLOT_COLUMNS)} AS INTEGER) AS slot, "
    "min(l_extendedprice) AS p FROM lineitem GROUP BY 1, 2)"
)

_WIDE = (
    "wide AS (SELECT d AS delivery_day, "
    + ", ".join(f"round(min(p) FILTER (WHERE slot = {i}), 2) AS {c}" for i, c in enumerate(SLOT_COLUMNS))
    + " FROM cells GROUP BY d)"
)

# Long chain: every cell (nulls kept) -> priced cells with local time ->
# first / later UTC instant and the two flags -> resolved UTC.
_LONG_CHAIN = [
    _CELLS,
    _WIDE,
    f"unp AS (SELECT * FROM wide UNPIVOT INCLUDE NULLS (price FOR hour_name IN ({_SLOT_LIST})))",
    "slots AS (SELECT delivery_day, hour_name, price, "
    "CAST(regexp_extract(hour_name, '([0-9]+)', 1) AS INTEGER) AS hour FROM unp)",
    "timed AS (SELECT *, CAST(delivery_day AS TIMESTAMP) + to_hours(hour - 1) AS ts "
    "FROM slots WHERE price IS NOT NULL AND NOT isnan(price))",
    f"zoned AS (SELECT *, timezone('UTC', timezone('{TZ}', ts)) AS u_later FROM timed)",
    "flagged AS (SELECT *, "
    f"timezone('{TZ}', timezone('UTC', u_later)) <> ts AS is_nonexistent, "
    f"timezone('{TZ}', timezone('UTC', u_later - INTERVAL 1 HOUR)) = ts AS is_ambiguous FROM zoned)",
    "resolved AS (SELECT *, "
    "CASE WHEN is_ambiguous THEN u_later - INTERVAL 1 HOUR ELSE u_later END AS u_first, "
    "CASE WHEN is_ambiguous AND lower(regexp_extract(hour_name, '[0-9]+([A-Za-z]*)$', 1)) <> 'b' "
    "THEN u_later - INTERVAL 1 HOUR ELSE u_later END AS utc FROM flagged)",
    "long AS (SELECT ts AS " + _q("timestamp") + ", utc AS timestamp_utc, price, "
    f"'{TZ} UTC+' || CAST(CAST(date_diff('hour', utc, ts) AS INTEGER) AS VARCHAR) AS timezone, "
    "CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, "
    "delivery_day, hour_name FROM resolved WHERE NOT is_nonexistent)",
]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _hours_in_day(day: str) -> str:
    def utc(expr: str) -> str:
        return f"timezone('UTC', timezone('{TZ}', CAST({expr} AS TIMESTAMP)))"

    return f"CAST((epoch({utc(day + ' + 1')}) - epoch({utc(day)})) / 3600 AS INTEGER)"


def _day_kind(hours: str) -> str:
    return (f"CASE WHEN {hours} = 23 THEN 'spring_forward' WHEN {hours} = 24 THEN 'normal' "
            f"WHEN {hours} = 25 THEN 'fall_back' ELSE 'irregular' END")


def _source_key(day: str) -> str:
    return f"'daa_market.' || strftime({day}, '%Y-%m')"


_WIDE_SELECT = "delivery_day, " + _SLOT_LIST
_LONG6 = _q("timestamp") + ", timestamp_utc, price, timezone, year, month"

_SPINE = ("spine AS (SELECT CAST(unnest(generate_series(CAST(min(delivery_day) AS TIMESTAMP), "
          "CAST(max(delivery_day) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS delivery_day FROM wide)")
_CALENDAR = (f"calendar AS (SELECT delivery_day, {_hours_in_day('delivery_day')} AS hours_in_day FROM spine)")
_VIOLATIONS = (
    "checked AS (SELECT delivery_day, "
    + _day_kind(_hours_in_day("delivery_day")) + " AS day_kind, "
    "hour_3a IS NOT NULL AND NOT isnan(hour_3a) AS hour_3a_set, "
    "hour_3b IS NOT NULL AND NOT isnan(hour_3b) AS hour_3b_set FROM wide),\n"
    "violations AS (SELECT *, CASE "
    "WHEN day_kind = 'normal' AND hour_3b_set THEN 'hour_3b_priced_on_normal_day' "
    "WHEN day_kind = 'normal' AND NOT hour_3a_set THEN 'hour_3a_missing_on_normal_day' "
    "WHEN day_kind = 'spring_forward' AND (hour_3a_set OR hour_3b_set) THEN 'skipped_hour_priced' "
    "WHEN day_kind = 'fall_back' AND NOT (hour_3a_set AND hour_3b_set) THEN 'repeated_hour_missing' "
    "END AS violation FROM checked)"
)
_STEPS = (
    "hc AS (SELECT CAST(" + _q("timestamp") + " AS DATE) AS delivery_day, timestamp_utc, "
    "count(*) AS n_rows FROM long GROUP BY 1, 2),\n"
    "st AS (SELECT *, lag(timestamp_utc) OVER (ORDER BY delivery_day, timestamp_utc) AS prev_timestamp_utc FROM hc),\n"
    "steps AS (SELECT *, CAST(epoch(timestamp_utc) - epoch(prev_timestamp_utc) AS BIGINT) AS step_seconds "
    "FROM st)"
)


def _completeness_status(n: str, expected: str) -> str:
    return (f"CASE WHEN {n} IS NULL OR {n} = 0 THEN 'missing' WHEN {n} < {expected} THEN 'incomplete' "
            f"WHEN {n} > {expected} THEN 'excess' ELSE 'complete' END")


def _last_day_of_month() -> str:
    return ("lastday AS (SELECT delivery_day, max(delivery_day) OVER "
            "(PARTITION BY year(delivery_day), month(delivery_day)) AS last_day FROM wide)")


_FULL_LONG = _with(*_LONG_CHAIN)

ORACLE: dict[str, str] = {
    "wide_snake_case": _with(_CELLS, _WIDE)
    + "SELECT strftime(delivery_day, '%d/%m/%Y') AS delivery_day, " + _SLOT_LIST + " FROM wide",
    "csv_roundtrip_scan": _with(_CELLS, _WIDE)
    + f"SELECT {_WIDE_SELECT}, {_source_key('delivery_day')} AS source_key FROM wide",
    # The key's parts come from the date, not from parsing the path.
    "file_key_parse": _with(_CELLS, _WIDE)
    + "SELECT delivery_day, 'daa_market/' || year(delivery_day) || '/' || m || '/daa_market.csv' AS file_key, "
    "'daa_market' AS top_folder, CAST(year(delivery_day) AS INTEGER) AS file_year, "
    "CAST(month(delivery_day) AS INTEGER) AS file_month, " + _source_key("delivery_day") + " AS source_key "
    "FROM (SELECT delivery_day, CAST(month(delivery_day) AS VARCHAR) AS m FROM wide "
    "UNION ALL SELECT delivery_day, strftime(delivery_day, '%m') AS m FROM wide) k",
    "unpivot_include_nulls": _with(*_LONG_CHAIN[:3]) + "SELECT delivery_day, hour_name, price FROM unp",
    "unpivot_drop_null_price": _with(*_LONG_CHAIN[:3])
    + "SELECT delivery_day, hour_name, price FROM unp WHERE price IS NOT NULL AND NOT isnan(price)",
    "slot_hour_extract": _with(*_LONG_CHAIN[:4]) + "SELECT delivery_day, hour_name, hour, price FROM slots",
    "slot_local_timestamp": _with(*_LONG_CHAIN[:5])
    + "SELECT delivery_day, hour_name, hour, ts AS " + _q("timestamp") + ", price FROM timed",
    "slot_label_filter": _with(*_LONG_CHAIN[:3])
    + "SELECT delivery_day, hour_name, price FROM unp WHERE price IS NOT NULL AND NOT isnan(price) "
    "AND hour_name IN ('hour_3a', 'hour_3b')",
    "ambiguous_split_union": _with(*_LONG_CHAIN[:3])
    + "SELECT delivery_day, hour_name, price, hour_name = 'hour_3a' AS is_hour_3a FROM unp "
    "WHERE price IS NOT NULL AND NOT isnan(price)",
    "local_to_utc_regular": _with(*_LONG_CHAIN[:8])
    + "SELECT delivery_day, hour_name, ts AS " + _q("timestamp") + ", utc AS timestamp_utc FROM resolved "
    "WHERE NOT is_ambiguous AND NOT is_nonexistent",
    "ambiguous_rows": _with(*_LONG_CHAIN[:8])
    + "SELECT delivery_day, hour_name, ts AS " + _q("timestamp") + ", price FROM resolved WHERE is_ambiguous",
    "nonexistent_rows": _with(*_LONG_CHAIN[:8])
    + "SELECT delivery_day, hour_name, ts AS " + _q("timestamp") + ", price FROM resolved WHERE is_nonexistent",
    "dst_resolve_by_label": _with(*_LONG_CHAIN[:8])
    + "SELECT delivery_day, hour_name, ts AS " + _q("timestamp") + ", utc AS timestamp_utc FROM resolved "
    "WHERE is_ambiguous",
    "utc_offset_label": _FULL_LONG
    + "SELECT " + _q("timestamp") + ", timestamp_utc, CAST(date_diff('hour', timestamp_utc, "
    + _q("timestamp") + ") AS INTEGER) AS utc_offset, timezone FROM long",
    "local_year_month": _FULL_LONG
    + "SELECT year, month, count(*) AS n_hours, min(" + _q("timestamp") + ") AS first_timestamp, "
    "max(" + _q("timestamp") + ") AS last_timestamp FROM long GROUP BY year, month",
    # Average rounded half away from zero on exact cents (Spark: DECIMAL avg).
    "monthly_price_summary": _FULL_LONG
    + ", c AS (SELECT year, month, timezone, price, CAST(round(price * 100) AS BIGINT) AS cents FROM long)\n"
    "SELECT year, month, timezone, count(*) AS n_hours, min(price) AS min_price, max(price) AS max_price, "
    "CAST(CAST(sum(cents) AS BIGINT) / 100.0 AS DOUBLE) AS sum_price, "
    "CAST(sign(sum(cents)) * ((abs(sum(cents)) * 2 + count(*)) // (2 * count(*))) AS BIGINT) / 100.0 "
    "AS avg_price FROM c GROUP BY year, month, timezone",
    "wide_to_long_full": _FULL_LONG + f"SELECT {_LONG6} FROM long ORDER BY timestamp_utc, " + _q("timestamp") + ", price, timezone",
    "dst_calendar": _with(_CELLS, _WIDE, _SPINE, _CALENDAR)
    + f"SELECT delivery_day, hours_in_day, {_day_kind('hours_in_day')} AS day_kind FROM calendar",
    "slot_pattern_violations": _with(_CELLS, _WIDE, _VIOLATIONS)
    + "SELECT delivery_day, day_kind, hour_3a_set, hour_3b_set, violation FROM violations "
    "WHERE violation IS NOT NULL",
    "dst_slots_all_null": _with(*_LONG_CHAIN[:3])
    + "SELECT delivery_day, coalesce(bool_and(CASE WHEN hour_name IN ('hour_3a', 'hour_3b') "
    "THEN price IS NULL OR isnan(price) END), true) AS dst_slots_all_null FROM unp GROUP BY delivery_day",
    "day_completeness": _FULL_LONG
    + ", per_day AS (SELECT CAST(" + _q("timestamp") + " AS DATE) AS delivery_day, count(*) AS n_hours "
    "FROM long GROUP BY 1),\n"
    "days AS (SELECT CAST(unnest(generate_series(CAST(min(delivery_day) AS TIMESTAMP), "
    "CAST(max(delivery_day) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS delivery_day FROM per_day),\n"
    "counted AS (SELECT delivery_day, coalesce(n_hours, 0) AS n_hours FROM days LEFT JOIN per_day USING (delivery_day))\n"
    f"SELECT delivery_day, n_hours, {_hours_in_day('delivery_day')} AS expected_hours, "
    + _completeness_status("n_hours", _hours_in_day("delivery_day")) + " AS status FROM counted",
    "utc_hour_gaps": _with(*_LONG_CHAIN, _STEPS)
    + "SELECT delivery_day, timestamp_utc, prev_timestamp_utc, step_seconds, n_rows FROM steps "
    "WHERE (prev_timestamp_utc IS NOT NULL AND step_seconds <> 3600) OR n_rows > 1",
    "quality_report": _with(*_LONG_CHAIN, _STEPS, _SPINE, _CALENDAR, _VIOLATIONS)
    + ", wide_days AS (SELECT delivery_day, count(*) AS n_wide_rows FROM wide GROUP BY 1),\n"
    "long_days AS (SELECT delivery_day, CAST(sum(n_rows) AS BIGINT) AS n_hours, "
    "CAST(sum(n_rows - 1) AS BIGINT) AS n_duplicate_hours, "
    "count(CASE WHEN prev_timestamp_utc IS NOT NULL AND step_seconds <> 3600 THEN 1 END) AS n_irregular_steps "
    "FROM steps GROUP BY 1),\n"
    "viol AS (SELECT delivery_day, min(violation) AS violation FROM violations "
    "WHERE violation IS NOT NULL GROUP BY 1),\n"
    "report AS (SELECT c.delivery_day, " + _day_kind("c.hours_in_day") + " AS day_kind, c.hours_in_day, "
    "coalesce(w.n_wide_rows, 0) AS n_wide_rows, coalesce(l.n_hours, 0) AS n_hours, "
    "coalesce(l.n_duplicate_hours, 0) AS n_duplicate_hours, "
    "coalesce(l.n_irregular_steps, 0) AS n_irregular_steps, v.violation "
    "FROM calendar c LEFT JOIN wide_days w USING (delivery_day) LEFT JOIN long_days l USING (delivery_day) "
    "LEFT JOIN viol v USING (delivery_day))\n"
    "SELECT *, CASE WHEN n_wide_rows = 0 THEN 'missing_day' WHEN violation IS NOT NULL THEN 'slot_pattern' "
    "WHEN n_duplicate_hours > 0 THEN 'duplicate_hours' WHEN n_irregular_steps > 0 THEN 'irregular_steps' "
    "WHEN n_hours <> hours_in_day THEN " + _completeness_status("n_hours", "hours_in_day")
    + " ELSE 'ok' END AS status FROM report",
    "parquet_partition_overwrite": _with(*_LONG_CHAIN, _last_day_of_month())
    + f"SELECT {_LONG6}, {_source_key('l.delivery_day')} AS source_key FROM long l JOIN lastday USING (delivery_day) "
    f"WHERE NOT (l.delivery_day = last_day AND month(l.delivery_day) > {OVERWRITE_LAST_MONTH}) "
    f"AND month(l.delivery_day) <> {EMPTIED_MONTH}",
    "catalog_range_local": _FULL_LONG
    + f"SELECT {_LONG6} FROM long WHERE " + _q("timestamp")
    + f" >= TIMESTAMP '{LOCAL_RANGE[0]}' AND " + _q("timestamp") + f" < TIMESTAMP '{LOCAL_RANGE[1]}'",
    "catalog_range_utc": _FULL_LONG
    + f"SELECT {_LONG6} FROM long WHERE timestamp_utc >= TIMESTAMP '{UTC_RANGE[0]}' "
    f"AND timestamp_utc < TIMESTAMP '{UTC_RANGE[1]}'",
    "schema_evolution_read": _FULL_LONG
    + "SELECT " + _q("timestamp") + ", timestamp_utc, price, timezone, "
    f"CASE WHEN month > {OVERWRITE_LAST_MONTH} THEN CAST(date_diff('hour', timestamp_utc, "
    + _q("timestamp") + ") AS INTEGER) END AS utc_offset, CAST(hour(" + _q("timestamp")
    + f") + CASE WHEN month > {OVERWRITE_LAST_MONTH} THEN 0.5 ELSE 0 END AS DOUBLE) AS hour_mid, "
    f"CASE WHEN month <= {OVERWRITE_LAST_MONTH} THEN 'first half' END AS origin, year, month FROM long",
    "latest_file_version": _with(_CELLS, _WIDE)
    + f"SELECT {_WIDE_SELECT}, {_source_key('delivery_day')} AS source_key FROM wide",
    "incremental_modified_after": _FULL_LONG + f"SELECT {_LONG6} FROM long",
    # Skipped hours of a month's last day are missing where only version 1 exists.
    "quarantine_ledger": _with(*_LONG_CHAIN[:8], _last_day_of_month())
    + f"SELECT {_source_key('delivery_day')} AS source_key, delivery_day, hour_name, price, ts AS "
    + _q("timestamp") + ", 'nonexistent_local_time' AS reject_reason FROM resolved JOIN lastday USING (delivery_day) "
    f"WHERE is_nonexistent AND NOT (delivery_day = last_day AND month(delivery_day) > {OVERWRITE_LAST_MONTH})",
    "stream_available_now": _FULL_LONG + f"SELECT {_LONG6} FROM long",
}
