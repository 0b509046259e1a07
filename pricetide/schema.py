"""Table layouts of the wide price file and the long hourly table."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# The wide file's header, in file order. One delivery day per
# row, then 25 price slots; "Hour 3A" / "Hour 3B" are the first and second
# 02:00 of a day whose clocks go back.
DAY_HEADER = "Delivery day"
SLOT_HEADERS = [
    "Hour 1", "Hour 2", "Hour 3A", "Hour 3B", "Hour 4", "Hour 5", "Hour 6",
    "Hour 7", "Hour 8", "Hour 9", "Hour 10", "Hour 11", "Hour 12", "Hour 13",
    "Hour 14", "Hour 15", "Hour 16", "Hour 17", "Hour 18", "Hour 19",
    "Hour 20", "Hour 21", "Hour 22", "Hour 23", "Hour 24",
]
# File conventions and the default market zone.
COMMENT_CHAR = "#"
DAY_PARSE_FORMAT = "d/M/yyyy"    # also takes 01/05/2024
DEFAULT_TIMEZONE = "Europe/Berlin"
DEFAULT_TOP_FOLDER = "daa_market"

# Texts of a cell that mean "no value", as the usual data-frame
# CSV readers take them.
NULL_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# The long table's columns, in order.
LONG_COLUMNS = ["timestamp", "timestamp_utc", "price", "timezone", "year", "month"]


def snake_case(name: str) -> str:
    """Whitespace runs become one underscore, then lower case."""
    return re.sub(r"\s+", "_", name).lower()


DAY_COLUMN = snake_case(DAY_HEADER)
SLOT_COLUMNS = [snake_case(h) for h in SLOT_HEADERS]

# Wide file as it is read: every cell as text, matched to the header by name.
WIDE_TEXT_SCHEMA = T.StructType(
    [T.StructField(DAY_HEADER, T.StringType(), True)]
    + [T.StructField(h, T.StringType(), True) for h in SLOT_HEADERS]
)

LONG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), True),
        T.StructField("timestamp_utc", T.TimestampNTZType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("timezone", T.StringType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("month", T.IntegerType(), True),
    ]
)
