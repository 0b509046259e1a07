"""Wide price frame derived from the ``lineitem`` table.

The test tables hold no price file, so one is derived: the delivery day is
the ship date, the slot is ``(l_orderkey + l_linenumber) % 25`` in file slot
order, and the cell is the smallest extended price of that (day, slot),
rounded to cents. Empty cells occur naturally, and skipped / repeated hours
carry prices, so every DST case shows up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.schema import DAY_COLUMN, DAY_HEADER, SLOT_COLUMNS, SLOT_HEADERS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day_slot_cells(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_shipdate").cast("date").alias("_day"),
        ((F.col("l_orderkey") + F.col("l_linenumber")) % len(SLOT_HEADERS)).cast("int").alias("_slot"),
        F.col("l_extendedprice").alias("_price"),
    )


def _pivot_min(cells: DataFrame, names: list[str]) -> DataFrame:
    # One hash aggregate with 25 conditional minimums: partial aggregation on
    # the map side collapses even a day holding a third of all rows to one
    # row per task before the single shuffle on the day.
    aggs = [F.expr(f"round(min(CASE WHEN _slot = {i} THEN _price END), 2) AS `{n}`")
            for i, n in enumerate(names)]
    return cells.groupBy("_day").agg(*aggs)


def wide_prices(lineitem: DataFrame) -> DataFrame:
    """Wide frame as the price file has it: ``Delivery day`` as day-first
    text, then ``Hour 1`` ... ``Hour 24`` with 3A / 3B."""
    wide = _pivot_min(_day_slot_cells(lineitem), SLOT_HEADERS)
    return wide.select(F.date_format("_day", "dd/MM/yyyy").alias(DAY_HEADER), *SLOT_HEADERS)


def wide_prices_typed(lineitem: DataFrame) -> DataFrame:
    """Same content, already typed: ``delivery_day`` DATE + snake-case slots."""
    wide = _pivot_min(_day_slot_cells(lineitem), SLOT_COLUMNS)
    return wide.withColumnRenamed("_day", DAY_COLUMN)
