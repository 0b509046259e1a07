"""File -> table job (X2): list, key, latest version, transform, write, commit.

Files are taken in rounds of at most ``round_units`` units (keys, or files without
a key). A round writes its rejects and its rows to a run's own folders and
then commits them together (:mod:`pricetide.plans.versions`), so a job that ends
between rounds goes on from there, and one that dies inside a round has changed
nothing that a reader sees.

Run as a job: ``spark-submit --py-files pricetide.zip ingest_job.py --source <files> --target <table folder>``
(locally ``python -m pricetide.plans.ingest ...``).
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.operators.long import (
    REJECT_MALFORMED,
    REJECT_UNKEYED,
    annotate_long,
    finish_long,
    rejected_rows,
)
from pricetide.plans.keyed_table import checked, run_folder, sync_catalog, write_run
from pricetide.plans.versions import SCHEMA, commit, new_run, not_older, read_versions
from pricetide.schema import DAY_HEADER, DEFAULT_TIMEZONE, WIDE_TEXT_SCHEMA
from pricetide.session import materialize
from pricetide.sources.csv_wide import MALFORMED_COLUMN, read_wide_csv
from pricetide.sources.file_keys import UNKEYED, latest_files, list_files, with_file_key

POLICIES = ("raise", "drop", "quarantine")
ROUND_UNITS = 1000


@dataclass
class IngestOptions:
    """``on_nonexistent`` treats priced skipped hours; ``on_invalid`` cells with
    a bad day or price, malformed lines and files without a key. Each is
    ``raise`` (default), ``drop`` or ``quarantine``, which needs
    ``quarantine_path``: nothing is lost unless dropping is asked for."""

    timezone: str = DEFAULT_TIMEZONE
    on_nonexistent: str = "raise"
    on_invalid: str = "raise"
    on_ambiguous: str = "first"
    quarantine_path: str | None = None
    database: str | None = None
    table: str | None = None
    round_units: int = ROUND_UNITS

    def __post_init__(self) -> None:
        for policy in (self.on_nonexistent, self.on_invalid):
            if policy not in POLICIES:
                raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
        if self.quarantines and not self.quarantine_path:
            raise ValueError("policy 'quarantine' needs quarantine_path: rejected cells must be written somewhere")

    @property
    def quarantines(self) -> bool:
        return "quarantine" in (self.on_nonexistent, self.on_invalid)


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Keyed wide rows of exactly these files."""
    if not paths:
        return with_file_key(spark.createDataFrame([], WIDE_TEXT_SCHEMA).select(
            "*", F.lit(None).cast("string").alias(MALFORMED_COLUMN), F.lit(None).cast("string").alias("file_path"),
            F.lit(None).cast("timestamp").alias("file_modification_time")))
    return with_file_key(read_wide_csv(spark, paths))


def read_latest(spark: SparkSession, source: str | list[str], modified_after: str | None = None) -> DataFrame:
    """Rows of the newest file of every key under ``source`` (S9): the listing
    decides, only the winners are scanned. Their paths pass through the
    driver, which holds every scan's file list anyway."""
    winners = latest_files(list_files(spark, source, modified_after)).select("file_path")
    return read_files(spark, sorted(r.file_path for r in winners.collect()))


def _whole_lines(wide: DataFrame, policy: str) -> DataFrame:
    """Rows of well-formed lines of keyed files; under ``raise`` another row
    fails the task that meets it."""
    wrong = F.when(F.col(MALFORMED_COLUMN).isNotNull(), F.lit(REJECT_MALFORMED)).when(
        F.col("source_key").isNull(), F.lit(REJECT_UNKEYED))
    good = wrong.isNull()
    if policy == "raise":
        # The check is part of the filter: column pruning cannot skip it.
        message = F.concat(F.lit("rejected line ("), wrong, F.lit("): "),
                           F.coalesce("file_path", F.lit("?")), F.lit(" "),
                           F.coalesce(MALFORMED_COLUMN, DAY_HEADER, F.lit("")))
        good = F.when(good, F.lit(True)).otherwise(F.raise_error(message))
    return wide.filter(good).drop(MALFORMED_COLUMN)


def rejects(wide: DataFrame, options: IngestOptions) -> DataFrame:
    """What the policies quarantine, with the original day and cell text:
    every rejected cell, and malformed or unkeyed lines. ``unit`` is the key, or
    the path of a file without one, whose next version replaces the row."""
    columns = ["unit", "source_key", "file_path", "delivery_day", "delivery_day_text", "hour_name", "cell_text",
               "timestamp", "reject_reason"]
    unit = F.coalesce("source_key", "file_path").alias("unit")
    cells = rejected_rows(annotate_long(_whole_lines(wide, "quarantine"), options.timezone, options.on_ambiguous))
    kept = F.when(F.col("reject_reason") == "nonexistent_local_time", F.lit(options.on_nonexistent)).otherwise(
        F.lit(options.on_invalid)) == "quarantine"
    out = cells.filter(kept).select("*", unit).select(columns)
    if options.on_invalid != "quarantine":
        return out
    lines = wide.filter(F.col(MALFORMED_COLUMN).isNotNull() | F.col("source_key").isNull())
    line = F.coalesce(F.col(MALFORMED_COLUMN), F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit(""))
                                                                  for c in WIDE_TEXT_SCHEMA.names]))
    reason = F.when(F.col(MALFORMED_COLUMN).isNotNull(), REJECT_MALFORMED).otherwise(REJECT_UNKEYED)
    whole = lines.select(
        unit, F.coalesce("source_key", F.lit(UNKEYED)).alias("source_key"), "file_path",
        F.lit(None).cast("date").alias("delivery_day"), F.col(DAY_HEADER).alias("delivery_day_text"),
        F.lit(None).cast("string").alias("hour_name"), line.alias("cell_text"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp"),
        reason.alias("reject_reason"))
    return out.unionByName(whole)


def ingest_rows(wide: DataFrame, units: DataFrame, target: str, options: IngestOptions, run: str) -> None:
    """Transform keyed wide rows, write them and their rejects to the folders of
    ``run`` and commit: from then on they are the whole content of ``units``
    (unit, source_key, file_path, file_modification_time). The transform is
    narrow, so both writes derive it from the files; nothing is held on
    executor disks between them."""
    spark = wide.sparkSession
    annotated = annotate_long(_whole_lines(wide, options.on_invalid), options.timezone, options.on_ambiguous)
    long = finish_long(annotated, options.timezone, options.on_nonexistent, options.on_invalid,
                       keep_columns=["source_key"])
    long = checked(long, options.database, options.table)
    if options.quarantines:
        rejects(wide, options).write.parquet(run_folder(options.quarantine_path, run))
    write_run(long, target, run)
    commit(spark, target, units.select("unit", "source_key", "file_path", "file_modification_time",
                                       F.lit(run).alias("run")))
    if options.database and options.table:
        sync_catalog(spark, target, options.database, options.table, long.schema)


def _rounds(winners: DataFrame, most: int):
    """Lists of at most ``most`` rows; the driver holds one at a time, give or
    take the unevenness of a hash."""
    first = winners.limit(most + 1).collect()
    if len(first) <= most:
        if first:
            yield first
        return
    stored = materialize(winners, winners.sparkSession, "files-to-read")
    parts = -(-stored.count() // most)
    for part in range(parts):
        rows = stored.filter(F.pmod(F.xxhash64("unit"), F.lit(parts)) == part).collect()
        for i in range(0, len(rows), most):
            yield rows[i:i + most]


def ingest_listing(spark: SparkSession, files: DataFrame, target: str, options: IngestOptions,
                   new_only: bool) -> int:
    """Ingest the newest file per unit of a listing, unless a later one is on
    record for it (``new_only``: or the same one). Returns the number of
    files read. Batch and stream both end here."""
    winners = not_older(latest_files(files), read_versions(spark, target), equal=not new_only).select(
        "unit", "source_key", "file_path", "file_modification_time")
    units = SCHEMA.rsplit(",", 1)[0]
    read = 0
    for rows in _rounds(winners, options.round_units):
        ingest_rows(read_files(spark, sorted(r.file_path for r in rows)), spark.createDataFrame(rows, units), target,
                    options, new_run())
        read += len(rows)
    return read


def ingest(spark: SparkSession, source: str | list[str], target: str,
           options: IngestOptions | None = None, modified_after: str | None = None,
           new_only: bool = False) -> int:
    """Batch job: the newest wide file of every key under ``source`` -> long
    table at ``target`` and, if a table name is given, the catalog (S5).

    ``modified_after`` (UTC, such as ``versions.stored_watermark``) lists only files
    changed after that instant; ``new_only`` skips files on record, so a file
    that lands late is still found. An older file never replaces a newer
    version of its key. Returns the number of files read."""
    options = options or IngestOptions()
    return ingest_listing(spark, list_files(spark, source, modified_after), target, options, new_only)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Wide price files -> long price table")
    parser.add_argument("--source", required=True, nargs="+", help="file, folder or glob of wide CSV files")
    parser.add_argument("--target", required=True, help="folder of the long Parquet table")
    parser.add_argument("--timezone", default=DEFAULT_TIMEZONE)
    parser.add_argument("--modified-after", help="only files changed after this UTC time")
    parser.add_argument("--new-only", action="store_true", help="only files that are not on record")
    parser.add_argument("--quarantine", help="folder for rejected cells")
    parser.add_argument("--on-nonexistent", default="raise", choices=POLICIES)
    parser.add_argument("--on-invalid", default="raise", choices=POLICIES)
    parser.add_argument("--database")
    parser.add_argument("--table")
    parser.add_argument("--round-units", type=int, default=ROUND_UNITS, help="keys or unkeyed files per commit")
    args = parser.parse_args(argv)
    from pricetide.session import build_session

    options = IngestOptions(timezone=args.timezone, on_nonexistent=args.on_nonexistent,
                            on_invalid=args.on_invalid, quarantine_path=args.quarantine,
                            database=args.database, table=args.table, round_units=args.round_units)
    spark = build_session(app_name="pricetide-ingest")
    ingest(spark, args.source, args.target, options, modified_after=args.modified_after, new_only=args.new_only)


if __name__ == "__main__":
    main()
