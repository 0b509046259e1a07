"""Queries over the long table by local or UTC time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_datetime(value: str | dt.datetime | dt.date) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(value)


def ntz_literal(value: str | dt.datetime | dt.date) -> Column:
    """A TIMESTAMP_NTZ literal; never goes through the session time zone."""
    return F.lit(_as_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


def month_range_predicate(start: dt.datetime, end: dt.datetime) -> Column:
    """``(year, month)`` between the months of ``start`` and ``end``; uses
    partition columns only, so the scan skips other folders. The plain bounds
    on ``year`` are what a metastore can evaluate by itself."""
    lo = start.year * 100 + start.month
    hi = end.year * 100 + end.month
    ym = F.col("year") * 100 + F.col("month")
    year = F.col("year")
    return (year >= start.year) & (year <= end.year) & (ym >= lo) & (ym <= hi)


def read_range(df: DataFrame, start, end, by: str = "local") -> DataFrame:
    """Rows with ``start <= time < end``, ``by`` local wall time
    (``timestamp``) or UTC (``timestamp_utc``).

    A range on a time column does not by itself prune the year / month
    folders, so the matching month predicate is added. Partitions hold local
    months; for a UTC range the months are widened by one day each side (no
    zone is more than a day off UTC).
    """
    start, end = _as_datetime(start), _as_datetime(end)
    if by not in ("local", "utc"):
        raise ValueError("by must be 'local' or 'utc'")
    column = "timestamp" if by == "local" else "timestamp_utc"
    pad = dt.timedelta(days=1) if by == "utc" else dt.timedelta(0)
    pred = month_range_predicate(start - pad, end + pad)
    return df.filter(pred).filter((F.col(column) >= ntz_literal(start)) & (F.col(column) < ntz_literal(end)))


def range_sql(table: str, start, end, by: str = "local", columns: str = "*") -> str:
    """The same range as :func:`read_range`, as SQL text for ``spark.sql``
    over a catalog table (month predicate included for partition pruning)."""
    start, end = _as_datetime(start), _as_datetime(end)
    column = "timestamp" if by == "local" else "timestamp_utc"
    pad = dt.timedelta(days=1) if by == "utc" else dt.timedelta(0)
    lo, hi = start - pad, end + pad
    return (f"SELECT {columns} FROM {table} "
            f"WHERE year >= {lo.year} AND year <= {hi.year} "
            f"AND year * 100 + month BETWEEN {lo.year * 100 + lo.month} AND {hi.year * 100 + hi.month} "
            f"AND `{column}` >= TIMESTAMP_NTZ'{start.isoformat(sep=' ')}' "
            f"AND `{column}` < TIMESTAMP_NTZ'{end.isoformat(sep=' ')}'")


# Digits after the point that prices are summed with, exactly.
PRICE_SCALE = 6


def exact_price(price: Column) -> Column:
    """The price as a decimal of ``PRICE_SCALE`` places; a price that has more
    fails instead of being rounded."""
    exact = price.cast(f"decimal(18,{PRICE_SCALE})")
    message = F.concat(F.lit(f"price has more than {PRICE_SCALE} decimal places: "), price.cast("string"))
    return F.when(price.isNull() | (exact.cast("double") == price), exact).otherwise(
        F.raise_error(message).cast(f"decimal(18,{PRICE_SCALE})"))


def monthly_summary(long: DataFrame) -> DataFrame:
    """Hours, min / max, exact sum and average price (to cents) per local month
    and zone label. Prices are summed as exact decimals, so the result depends
    neither on the order of the rows nor on their number of places."""
    exact = exact_price(F.col("price"))
    return (long.groupBy("year", "month", "timezone")
                .agg(F.count(F.lit(1)).alias("n_hours"),
                     F.min("price").alias("min_price"),
                     F.max("price").alias("max_price"),
                     F.sum(exact).cast("double").alias("sum_price"),
                     F.round(F.avg(exact), 2).cast("double").alias("avg_price")))
