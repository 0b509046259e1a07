"""File-source streaming ingest."""

from pricetide.streaming.ingest_stream import file_stream, run_available_now, start_ingest_stream  # noqa: F401
