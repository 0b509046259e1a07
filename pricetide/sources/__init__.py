"""Scans, listings and file keys."""

from pricetide.sources.csv_wide import read_wide_csv, write_wide_csv  # noqa: F401
from pricetide.sources.file_keys import latest_files, list_files, parse_file_key, with_file_key  # noqa: F401
from pricetide.sources.lineitem import wide_prices, wide_prices_typed  # noqa: F401
