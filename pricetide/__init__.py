"""Spark-native day-ahead price tables: wide hourly files -> long table with
DST-correct local and UTC time, partitioned Parquet sink, catalog, batch and
streaming pick-up, and data-quality reports."""

from pricetide.operators.long import to_long  # noqa: F401
from pricetide.schema import DEFAULT_TIMEZONE, LONG_COLUMNS  # noqa: F401
from pricetide.session import build_session, scratch_path  # noqa: F401

__version__ = "0.1.0"
