"""Registered queries: one per operator of the inventory, each on the given
tables (the wide price frame is derived from ``lineitem``), returning a
DataFrame whose columns match the DuckDB oracle in :mod:`pricetide.oracle`.

Queries that exercise a sink or a source first write to a fresh folder under
the shared checkpoint folder, then return a lazy read of what was written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricetide.functions.slots import parse_delivery_day
from pricetide.operators.long import annotate_long, long_with_nulls, to_long, with_zone_columns
from pricetide.operators.quality import (
    day_completeness,
    day_spine,
    dst_calendar,
    dst_slots_all_null,
    quality_report,
    slot_pattern_violations,
    utc_hour_gaps,
)
from pricetide.operators.reshape import (
    drop_missing_price,
    slot_label_filter,
    snake_case_columns,
    split_by,
    union_parts,
    with_slot_time,
)
from pricetide.plans.ingest import IngestOptions, ingest, read_latest
from pricetide.plans.query import monthly_summary, range_sql, read_range
from pricetide.plans.keyed_table import read_current, read_rejects, replace_keys, sync_catalog
from pricetide.plans.sink import conform, register_table, write_long_table
from pricetide.plans.versions import stored_watermark
from pricetide.schema import (
    DAY_COLUMN,
    DAY_HEADER,
    DEFAULT_TIMEZONE,
    DEFAULT_TOP_FOLDER,
    LONG_COLUMNS,
    SLOT_COLUMNS,
    SLOT_HEADERS,
)
from pricetide.session import materialize, scratch_path
from pricetide.sources.csv_wide import read_wide_csv, write_wide_csv
from pricetide.sources.file_keys import parse_file_key, with_file_key
from pricetide.sources.lineitem import read_table, wide_prices, wide_prices_typed
from pricetide.streaming.ingest_stream import run_available_now

TZ = DEFAULT_TIMEZONE

# The ranges of the two catalog range queries (they span the
# spring and autumn changes of 1998).
LOCAL_RANGE = ("1998-03-01 00:00:00", "1998-11-01 00:00:00")
UTC_RANGE = ("1998-03-28 22:00:00", "1998-10-26 00:00:00")
# Months rewritten by the partition-overwrite query (first half of each year),
# and those of them whose second version has no row at all.
OVERWRITE_LAST_MONTH = 6
EMPTIED_MONTH = 2



# -- inputs -----------------------------------------------------------------

def wide_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide frame with the file's header names and day-first text dates."""
    return wide_prices(read_table(spark, sf_dir, "lineitem"))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed wide frame: ``delivery_day`` DATE + snake-case DOUBLE slots."""
    return wide_prices_typed(read_table(spark, sf_dir, "lineitem"))


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_long(wide(spark, sf_dir), TZ, on_nonexistent="drop")


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate_long(wide(spark, sf_dir), TZ)


def _with_source_key(long: DataFrame) -> DataFrame:
    return long.withColumn("source_key", F.format_string(f"{DEFAULT_TOP_FOLDER}.%04d-%02d", F.col("year"),
                                                         F.col("month")))


def _partial_and_complete(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of every month file in text form: the first lacks the
    month's last delivery day (as a file appended to day by day), the second
    is complete."""
    # Several writes read this frame: derive it from lineitem once and cut
    # its lineage (a table in the shared folder; one row per day).
    w = materialize(wide_text(spark, sf_dir), spark, "wide-text")
    day = parse_delivery_day(DAY_HEADER)
    month = Window.partitionBy(F.year(day), F.month(day))  # a month: at most 31 rows
    partial = (w.withColumn("_last", F.max(day).over(month))
                .filter(day < F.col("_last")).drop("_last"))
    return partial, w


def _typed_from_files(df: DataFrame) -> DataFrame:
    return df.select(
        parse_delivery_day(DAY_HEADER).alias(DAY_COLUMN),
        *[F.col(h).try_cast("double").alias(c) for h, c in zip(SLOT_HEADERS, SLOT_COLUMNS)],
        "source_key",
    )


# -- scans, keys, reshape -------------------------------------------------

def q_wide_snake_case(spark, sf_dir):
    return snake_case_columns(wide_text(spark, sf_dir))


def q_csv_roundtrip_scan(spark, sf_dir):
    root = scratch_path(spark, "csv-roundtrip")
    write_wide_csv(wide_text(spark, sf_dir), root)
    files = with_file_key(read_wide_csv(spark, root))
    return _typed_from_files(files)


def q_file_key_parse(spark, sf_dir):
    # Both ways producers write a month folder (``5`` and ``05``) for every
    # delivery day; both must give the same source key.
    d = F.col(DAY_COLUMN)
    month = F.month(d).cast("string")
    keys = [F.concat(F.lit("daa_market/"), F.year(d).cast("string"), F.lit("/"), m, F.lit("/daa_market.csv"))
            for m in (month, F.lpad(month, 2, "0"))]
    rows = wide(spark, sf_dir).select(DAY_COLUMN, F.explode(F.array(*keys)).alias("file_key"))
    parsed = parse_file_key("file_key")
    return rows.select(DAY_COLUMN, "file_key", *[v.alias(k) for k, v in parsed.items()])


def q_unpivot_include_nulls(spark, sf_dir):
    return long_with_nulls(wide(spark, sf_dir)).select(DAY_COLUMN, "hour_name", "price")


def q_unpivot_drop_null_price(spark, sf_dir):
    return drop_missing_price(long_with_nulls(wide(spark, sf_dir))).select(DAY_COLUMN, "hour_name", "price")


def q_slot_hour_extract(spark, sf_dir):
    long = with_slot_time(long_with_nulls(wide(spark, sf_dir)))
    return long.select(DAY_COLUMN, "hour_name", "hour", "price")


def q_slot_local_timestamp(spark, sf_dir):
    long = with_slot_time(drop_missing_price(long_with_nulls(wide(spark, sf_dir))))
    return long.select(DAY_COLUMN, "hour_name", "hour", "timestamp", "price")


def q_slot_label_filter(spark, sf_dir):
    long = drop_missing_price(long_with_nulls(wide(spark, sf_dir)))
    return slot_label_filter(long, ["hour_3a", "hour_3b"]).select(DAY_COLUMN, "hour_name", "price")


def q_ambiguous_split_union(spark, sf_dir):
    long = drop_missing_price(long_with_nulls(wide(spark, sf_dir))).select(DAY_COLUMN, "hour_name", "price")
    first, rest = split_by(long, F.col("hour_name") == "hour_3a")
    return union_parts(first.withColumn("is_hour_3a", F.lit(True)),
                       rest.withColumn("is_hour_3a", F.lit(False)))


# -- time zone --------------------------------------------------------------

def q_local_to_utc_regular(spark, sf_dir):
    a = _annotated(spark, sf_dir)
    return (a.filter(~F.col("is_ambiguous") & ~F.col("is_nonexistent"))
             .select(DAY_COLUMN, "hour_name", "timestamp", "timestamp_utc"))


def q_ambiguous_rows(spark, sf_dir):
    return _annotated(spark, sf_dir).filter("is_ambiguous").select(DAY_COLUMN, "hour_name", "timestamp", "price")


def q_nonexistent_rows(spark, sf_dir):
    return _annotated(spark, sf_dir).filter("is_nonexistent").select(DAY_COLUMN, "hour_name", "timestamp", "price")


def q_dst_resolve_by_label(spark, sf_dir):
    return (_annotated(spark, sf_dir).filter("is_ambiguous")
            .select(DAY_COLUMN, "hour_name", "timestamp", "timestamp_utc"))


def q_utc_offset_label(spark, sf_dir):
    a = _annotated(spark, sf_dir).filter(~F.col("is_nonexistent"))
    z = with_zone_columns(a, TZ)
    offset = (F.col("timestamp") - F.col("timestamp_utc")).cast("interval hour").cast("int")
    return z.select("timestamp", "timestamp_utc", offset.alias("utc_offset"), "timezone")


def q_local_year_month(spark, sf_dir):
    return (_long(spark, sf_dir).groupBy("year", "month")
            .agg(F.count(F.lit(1)).alias("n_hours"),
                 F.min("timestamp").alias("first_timestamp"),
                 F.max("timestamp").alias("last_timestamp")))


def q_monthly_price_summary(spark, sf_dir):
    return monthly_summary(_long(spark, sf_dir))


def q_wide_to_long_full(spark, sf_dir):
    # UTC order (O1). The whole row is the sort key, so range partitioning
    # can still split a UTC hour that repeats across many rows.
    return _long(spark, sf_dir).orderBy("timestamp_utc", "timestamp", "price", "timezone")


# -- quality ----------------------------------------------------------------

def q_dst_calendar(spark, sf_dir):
    return dst_calendar(day_spine(wide(spark, sf_dir)), TZ)


def q_slot_pattern_violations(spark, sf_dir):
    return slot_pattern_violations(wide(spark, sf_dir), TZ)


def q_dst_slots_all_null(spark, sf_dir):
    return dst_slots_all_null(wide(spark, sf_dir))


def q_day_completeness(spark, sf_dir):
    return day_completeness(_long(spark, sf_dir), TZ)


def q_utc_hour_gaps(spark, sf_dir):
    return utc_hour_gaps(_long(spark, sf_dir))


def q_quality_report(spark, sf_dir):
    # The report reads the wide frame three times; derived from lineitem it
    # is worth cutting its lineage once (a table in the shared folder).
    w = materialize(wide(spark, sf_dir), spark, "wide")
    return quality_report(w, to_long(w, TZ, on_nonexistent="drop"), TZ)


# -- sinks, catalog, incremental ------------------------------------------

def q_parquet_partition_overwrite(spark, sf_dir):
    """Two versions of the month keys, each committed as a whole; read by the
    catalog, whose partitions are switched from the first to the second."""
    path = scratch_path(spark, "long-table")
    table = "t_" + path.rsplit("-", 1)[-1]
    partial, complete = _partial_and_complete(spark, sf_dir)

    def keys(df):
        return sorted(r.source_key for r in df.select("source_key").distinct().collect())  # one row per month file

    first = _with_source_key(to_long(partial, TZ, on_nonexistent="drop"))
    replace_keys(first, path, keys(first), "1")
    sync_catalog(spark, path, "energy_market", table, first.schema)
    # Version 2 of the keys of these months: complete, but February is empty.
    rewritten = F.month(parse_delivery_day(DAY_HEADER)) <= OVERWRITE_LAST_MONTH
    second = _with_source_key(to_long(complete.filter(rewritten), TZ, on_nonexistent="drop"))
    replace_keys(second.filter(F.col("month") != EMPTIED_MONTH), path, keys(second), "2")
    name = sync_catalog(spark, path, "energy_market", table, second.schema)
    return spark.table(name).select(*LONG_COLUMNS, "source_key")


def _registered_long_table(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "catalog-table")
    write_long_table(_with_source_key(_long(spark, sf_dir)), path)
    name = "t_" + path.rsplit("-", 1)[-1]
    return register_table(spark, path, "energy_market", name)


def q_catalog_range_local(spark, sf_dir):
    table = _registered_long_table(spark, sf_dir)
    return read_range(spark.table(table), *LOCAL_RANGE, by="local").select(*LONG_COLUMNS)


def q_catalog_range_utc(spark, sf_dir):
    # SQL API over the catalog table (the local-time twin uses the DataFrame API).
    table = _registered_long_table(spark, sf_dir)
    return spark.sql(range_sql(table, *UTC_RANGE, by="utc", columns=", ".join(f"`{c}`" for c in LONG_COLUMNS)))


def q_schema_evolution_read(spark, sf_dir):
    """Later files have a new column (utc_offset), a wider one (hour_mid: whole
    hours, then half hours) and lack one (origin)."""
    path = scratch_path(spark, "evolving-table")
    name = "t_" + path.rsplit("-", 1)[-1]
    long = _with_source_key(_long(spark, sf_dir))
    hour = F.hour("timestamp")
    old = (long.filter(F.col("month") <= OVERWRITE_LAST_MONTH)
               .withColumn("hour_mid", hour).withColumn("origin", F.lit("first half")))
    new = (long.filter(F.col("month") > OVERWRITE_LAST_MONTH)
               .withColumn("hour_mid", hour + F.lit(0.5))
               .withColumn("utc_offset",
                           (F.col("timestamp") - F.col("timestamp_utc")).cast("interval hour").cast("int")))
    write_long_table(old, path)
    register_table(spark, path, "energy_market", name, schema=old.schema)
    new = conform(new, "energy_market", name)
    write_long_table(new, path)
    table = register_table(spark, path, "energy_market", name, schema=new.schema)
    return spark.table(table).select("timestamp", "timestamp_utc", "price", "timezone", "utc_offset", "hour_mid",
                                     "origin", "year", "month")


def q_latest_file_version(spark, sf_dir):
    root = scratch_path(spark, "landing")
    partial, complete = _partial_and_complete(spark, sf_dir)
    write_wide_csv(partial, f"{root}/ingest=0001")
    write_wide_csv(complete, f"{root}/ingest=0002", pad_month=True)
    return _typed_from_files(read_latest(spark, root))


def _quarantining(spark: SparkSession) -> IngestOptions:
    """The derived frame prices skipped hours: those cells are quarantined."""
    return IngestOptions(timezone=TZ, on_nonexistent="quarantine", quarantine_path=scratch_path(spark, "quarantine"))


def q_incremental_modified_after(spark, sf_dir):
    root = scratch_path(spark, "landing")
    table = scratch_path(spark, "ingested")
    options = _quarantining(spark)
    partial, complete = _partial_and_complete(spark, sf_dir)
    write_wide_csv(partial, f"{root}/ingest=0001")
    ingest(spark, root, table, options)
    write_wide_csv(complete, f"{root}/ingest=0002")
    ingest(spark, root, table, options, modified_after=stored_watermark(spark, table), new_only=True)
    return read_current(spark, table).select(*LONG_COLUMNS)


def q_quarantine_ledger(spark, sf_dir):
    """The priced skipped hours after two versions of every month file: a
    file's rejects are those of its current version."""
    root = scratch_path(spark, "landing")
    table = scratch_path(spark, "ingested")
    options = _quarantining(spark)
    partial, complete = _partial_and_complete(spark, sf_dir)
    write_wide_csv(partial, f"{root}/ingest=0001")
    ingest(spark, root, table, options)
    # The second version exists of the first half of each year only.
    rewritten = F.month(parse_delivery_day(DAY_HEADER)) <= OVERWRITE_LAST_MONTH
    write_wide_csv(complete.filter(rewritten), f"{root}/ingest=0002")
    ingest(spark, root, table, options, new_only=True)
    return read_rejects(spark, table, options.quarantine_path).select(
        "source_key", "delivery_day", "hour_name", F.col("cell_text").try_cast("double").alias("price"), "timestamp",
        "reject_reason")


def q_stream_available_now(spark, sf_dir):
    """The second version of every month file overwrites the first under its
    own path, between two triggers."""
    root = scratch_path(spark, "landing")
    table = scratch_path(spark, "streamed")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    options = _quarantining(spark)
    partial, complete = _partial_and_complete(spark, sf_dir)
    write_wide_csv(partial, root)
    run_available_now(spark, root, table, checkpoint, options)
    write_wide_csv(complete, root)
    run_available_now(spark, root, table, checkpoint, options)
    return read_current(spark, table).select(*LONG_COLUMNS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "wide_snake_case": q_wide_snake_case,
    "csv_roundtrip_scan": q_csv_roundtrip_scan,
    "file_key_parse": q_file_key_parse,
    "unpivot_include_nulls": q_unpivot_include_nulls,
    "unpivot_drop_null_price": q_unpivot_drop_null_price,
    "slot_hour_extract": q_slot_hour_extract,
    "slot_local_timestamp": q_slot_local_timestamp,
    "slot_label_filter": q_slot_label_filter,
    "ambiguous_split_union": q_ambiguous_split_union,
    "local_to_utc_regular": q_local_to_utc_regular,
    "ambiguous_rows": q_ambiguous_rows,
    "nonexistent_rows": q_nonexistent_rows,
    "dst_resolve_by_label": q_dst_resolve_by_label,
    "utc_offset_label": q_utc_offset_label,
    "local_year_month": q_local_year_month,
    "monthly_price_summary": q_monthly_price_summary,
    "wide_to_long_full": q_wide_to_long_full,
    "dst_calendar": q_dst_calendar,
    "slot_pattern_violations": q_slot_pattern_violations,
    "dst_slots_all_null": q_dst_slots_all_null,
    "day_completeness": q_day_completeness,
    "utc_hour_gaps": q_utc_hour_gaps,
    "quality_report": q_quality_report,
    "parquet_partition_overwrite": q_parquet_partition_overwrite,
    "catalog_range_local": q_catalog_range_local,
    "catalog_range_utc": q_catalog_range_utc,
    "schema_evolution_read": q_schema_evolution_read,
    "latest_file_version": q_latest_file_version,
    "incremental_modified_after": q_incremental_modified_after,
    "quarantine_ledger": q_quarantine_ledger,
    "stream_available_now": q_stream_available_now,
}
