"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.session import materialize

# Rows of whole texts that a task works on at once: what is derived from long
# documents must fit in a Python worker beside its neighbours.
TEXT_BATCH_ROWS = 512


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def slices(batches: Iterable[pa.RecordBatch], rows: int = TEXT_BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, ``rows`` at most at a time: what a task derives from
    whole texts at once stays bounded, whatever the session's batch size."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for the jobs run inside; the
    session's own setting is put back afterwards, also after a failure."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, purpose: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written to a new folder of the shared checkpoint folder and read
    back: later jobs neither recompute it nor depend on an executor's disk.
    ``batch_rows`` bounds the Arrow batches of this job alone."""
    if batch_rows is None:
        return materialize(df, df.sparkSession, purpose)
    with arrow_rows(df.sparkSession, batch_rows):
        return materialize(df, df.sparkSession, purpose)


def text_key(text: Column, names: tuple[str, str]) -> list[Column]:
    """Two columns that tell texts apart: 128 bits of XXH64 under two seeds."""
    return [F.xxhash64(text).alias(names[0]), F.xxhash64(F.lit(1), text).alias(names[1])]


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z (and nothing else) in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_bucket(column: str, buckets: int) -> Column:
    """crc32 of an id as text, modulo ``buckets`` (null ids: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % buckets
