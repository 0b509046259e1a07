"""Jobs and queries built from the operators: sink, catalog, ingest, range reads."""

from pricetide.plans.ingest import IngestOptions, ingest, ingest_rows, read_latest  # noqa: F401
from pricetide.plans.query import monthly_summary, read_range  # noqa: F401
from pricetide.plans.keyed_table import read_current, read_rejects, replace_keys, sync_catalog, vacuum  # noqa: F401
from pricetide.plans.sink import read_long_table, register_table, write_long_table  # noqa: F401
