"""Wide-to-long reshaping and row selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.functions.slots import parse_delivery_day, slot_hour, slot_local_timestamp
from pricetide.schema import DAY_COLUMN, snake_case


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column: whitespace run -> ``_``, lower case.

    A schema-only change (driver side, no data touched)."""
    return df.toDF(*[snake_case(c) for c in df.columns])


def slot_columns(df: DataFrame, day_column: str = DAY_COLUMN) -> list[str]:
    """Every column but the delivery day is a price slot, as in the source
    file; lineage columns (``_``-prefixed or ``source_*``) are kept aside."""
    return [c for c in df.columns if c != day_column and not _is_lineage(c)]


def lineage_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if _is_lineage(c)]


def _is_lineage(name: str) -> bool:
    return name.startswith("_") or name.startswith("source_") or name.startswith("file_")


def type_slots(df: DataFrame, slots: list[str] | None = None, strict: bool = False) -> DataFrame:
    """Cast every slot to DOUBLE (unpivot needs one type).

    Text cells go through ``try_cast`` unless ``strict``, so a text that is
    not a number becomes null (:func:`annotate_long` reports such cells).
    """
    slots = slots if slots is not None else slot_columns(df)
    casts = {}
    for c in slots:
        src = F.trim(F.col(c)) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)
        casts[c] = src.cast("double") if strict else src.try_cast("double")
    return df.withColumns(casts)


def type_delivery_day(df: DataFrame, strict: bool = True, day_column: str = DAY_COLUMN) -> DataFrame:
    """Delivery day to DATE: day-first text is parsed (C2), a DATE or
    TIMESTAMP column is truncated to its date."""
    dtype = df.schema[day_column].dataType
    if isinstance(dtype, T.StringType):
        return df.withColumn(day_column, parse_delivery_day(F.trim(F.col(day_column)), strict=strict))
    if isinstance(dtype, T.DateType):
        return df
    return df.withColumn(day_column, F.col(day_column).cast("date"))


def drop_missing_price(df: DataFrame) -> DataFrame:
    """Drop rows whose price is null or NaN."""
    return df.dropna(subset=["price"])


def with_slot_time(df: DataFrame, day_column: str = DAY_COLUMN) -> DataFrame:
    """Add ``hour`` (C1) and the local wall time ``timestamp``."""
    return (df.withColumn("hour", slot_hour("hour_name"))
              .withColumn("timestamp", slot_local_timestamp(day_column, "hour")))


def slot_label_filter(df: DataFrame, labels: list[str]) -> DataFrame:
    """Rows whose slot label is in ``labels`` (P5)."""
    return df.filter(F.col("hour_name").isin(labels))


def split_by(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Two frames: rows where ``predicate`` holds, and all others.

    A null predicate counts as false, like a boolean mask."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.filter(hit), df.filter(~hit)


def union_parts(*parts: DataFrame) -> DataFrame:
    """Concatenate frames by column name, duplicates kept."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
