"""Sources, sinks, catalog, incremental and streaming pick-up."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from pricetide.plans.ingest import IngestOptions, ingest, read_latest
from pricetide.plans.keyed_table import read_current, read_rejects
from pricetide.plans.query import read_range
from pricetide.plans.sink import read_long_table, register_table, write_long_table
from pricetide.schema import LONG_COLUMNS
from pricetide.session import scratch_path
from pricetide.sources.csv_wide import COMMENT_LINE, read_wide_csv, write_wide_csv
from pricetide.sources.file_keys import parse_file_key, with_file_key
from pricetide.sources.lineitem import read_table, wide_prices
from pricetide.streaming.ingest_stream import run_available_now
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def wide_text(spark):
    return wide_prices(read_table(spark, SF_SMALL, "lineitem")).cache()


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _quarantining(spark):
    """The derived frame prices skipped hours, which the default refuses."""
    return IngestOptions(on_nonexistent="quarantine", quarantine_path=scratch_path(spark, "t-rejects"))


def _table(spark, path):
    return sorted(tuple(r) for r in read_current(spark, path).select(*LONG_COLUMNS).collect())


def test_landing_file_layout_and_scan(spark, wide_text):
    root = scratch_path(spark, "t-landing")
    out = write_wide_csv(wide_text, root)
    files = sorted(glob.glob(_local(out) + "/file_year=*/file_month=*/part-*"))
    assert files
    with open(files[0]) as fh:
        first = [fh.readline().rstrip("\n") for _ in range(3)]
    assert first[0] == COMMENT_LINE
    assert first[1].startswith("Delivery day,Hour 1,Hour 2,Hour 3A,Hour 3B,Hour 4")
    assert first[2][2] == "/" and first[2][5] == "/"  # dd/MM/yyyy
    back = with_file_key(read_wide_csv(spark, root))
    assert back.count() == wide_text.count()
    assert back.filter(F.col("source_key").isNull()).count() == 0
    n_keys = back.select("source_key").distinct().count()
    assert n_keys == len(files)


def test_header_is_checked(spark, tmp_path):
    good = "Delivery day," + ",".join(f"Hour {h}" for h in ["1", "2", "3A", "3B"] + [str(i) for i in range(4, 25)])
    swapped = good.replace("Hour 1,Hour 2", "Hour 2,Hour 1")
    for name, header in [("swapped", swapped), ("extra", good + ",Comment")]:
        d = tmp_path / name / "daa_market" / "2024" / "5"
        d.mkdir(parents=True)
        (d / "daa_market.csv").write_text("# x\n" + header + "\n01/05/2024" + ",1.0" * 25 + "\n")
        with pytest.raises(Exception):
            read_wide_csv(spark, str(tmp_path / name)).collect()


def test_file_key_forms(spark):
    keys = spark.createDataFrame(
        [("daa_market/2024/5/daa_market.csv",), ("s3://bucket/daa_market/2024/05/daa_market.csv",),
         ("file:/x/land/ingest=0002/daa_market/file_year=2024/file_month=05/part-0.txt",), ("no-key.csv",),
         ("daa_market/2024/13/x.csv",), ("daa_market/2024/0/x.csv",)],
        "p string")
    parsed = keys.select(*[v.alias(k) for k, v in parse_file_key("p").items()]).collect()
    assert [tuple(r) for r in parsed[:3]] == [("daa_market", 2024, 5, "daa_market.2024-05")] * 3
    assert [tuple(r) for r in parsed[3:]] == [(None,) * 4] * 3


def test_latest_version_wins_and_padding_meets(spark, wide_text):
    root = scratch_path(spark, "t-versions")
    older = wide_text.withColumn("Hour 1", F.lit(-1.0))
    write_wide_csv(older, f"{root}/ingest=0001")
    write_wide_csv(wide_text, f"{root}/ingest=0002", pad_month=True)
    rows = read_latest(spark, root)
    assert rows.count() == wide_text.count()
    assert rows.filter(F.col("Hour 1") == "-1.0").count() == 0


def test_ingest_rerun_changes_nothing_and_quarantines(spark, wide_text):
    root = scratch_path(spark, "t-src")
    table = scratch_path(spark, "t-table")
    quarantine = scratch_path(spark, "t-quarantine")
    write_wide_csv(wide_text, root)
    opts = IngestOptions(on_nonexistent="quarantine", quarantine_path=quarantine)
    ingest(spark, root, table, opts)
    first = _table(spark, table)
    ingest(spark, root, table, opts)
    assert _table(spark, table) == first
    q = read_rejects(spark, table, quarantine)
    assert q.count() >= 1
    assert {r.reject_reason for r in q.select("reject_reason").distinct().collect()} == {"nonexistent_local_time"}


def test_modified_after_reads_only_new_files(spark, wide_text):
    root = scratch_path(spark, "t-incr")
    write_wide_csv(wide_text, f"{root}/ingest=0001")
    seen = read_wide_csv(spark, root).agg(F.unix_micros(F.max("file_modification_time"))).first()[0]
    time.sleep(0.05)
    write_wide_csv(wide_text.filter(F.col("Delivery day").endswith("1995")), f"{root}/ingest=0002")
    import datetime as dt

    after = (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=seen)).isoformat(timespec="milliseconds")
    new = read_wide_csv(spark, root, modified_after=after)
    assert new.count() == wide_text.filter(F.col("Delivery day").endswith("1995")).count()
    assert new.filter(~F.col("file_path").contains("ingest=0002")).count() == 0


def test_stream_picks_up_new_versions_and_replay_is_idempotent(spark, wide_text):
    root = scratch_path(spark, "t-stream-src")
    table = scratch_path(spark, "t-stream-table")
    ckpt = scratch_path(spark, "t-stream-ckpt")
    options = _quarantining(spark)
    stale = wide_text.withColumn("Hour 1", F.lit(-5.0))
    write_wide_csv(stale, f"{root}/ingest=0001")
    run_available_now(spark, root, table, ckpt, options)
    assert read_current(spark, table).filter("price = -5.0").count() > 0
    write_wide_csv(wide_text, f"{root}/ingest=0002")
    run_available_now(spark, root, table, ckpt, options)
    after = _table(spark, table)
    assert not [r for r in after if r[2] == -5.0]
    run_available_now(spark, root, table, ckpt, options)  # nothing new
    assert _table(spark, table) == after


def test_stream_drops_a_late_older_version(spark, wide_text):
    root = scratch_path(spark, "t-late-src")
    table = scratch_path(spark, "t-late-table")
    ckpt = scratch_path(spark, "t-late-ckpt")
    options = _quarantining(spark)
    write_wide_csv(wide_text, f"{root}/ingest=0002")
    run_available_now(spark, root, table, ckpt, options)
    before = _table(spark, table)
    late = write_wide_csv(wide_text.withColumn("Hour 1", F.lit(-7.0)), f"{root}/ingest=0001")
    old = time.time() - 3600
    for f in glob.glob(_local(late) + "/**/part-*", recursive=True):
        os.utime(f, (old, old))
    run_available_now(spark, root, table, ckpt, options)
    assert _table(spark, table) == before


def test_catalog_range_reads_prune_partitions(spark, wide_text):
    from pricetide.operators.long import to_long

    path = scratch_path(spark, "t-cat")
    long = to_long(wide_text, on_nonexistent="drop").withColumn(
        "source_key", F.format_string("daa_market.%04d-%02d", "year", "month"))
    write_long_table(long, path)
    name = register_table(spark, path, "energy_market_test", "prices_" + path.rsplit("-", 1)[-1])
    assert spark.table(name).count() == long.count()
    local = read_range(spark.table(name), "1998-03-01", "1998-04-01", by="local")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = local._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "month" in filters and ">= 1998)" in filters and "<= 1998)" in filters and ">= 199803)" in filters
    got = local.collect()
    assert got and all(r.timestamp.year == 1998 and r.timestamp.month == 3 for r in got)
    utc = read_range(spark.table(name), "1998-03-31 22:00:00", "1998-04-01 02:00:00", by="utc").collect()
    assert {r.month for r in utc} <= {3, 4}
    sql = spark.sql(f"SELECT count(*) AS n FROM {name} WHERE timestamp_utc >= TIMESTAMP_NTZ'1998-03-01 00:00:00' "
                    "AND timestamp_utc < TIMESTAMP_NTZ'1998-04-01 00:00:00'").first().n
    assert sql > 0


def test_schema_evolution(spark, wide_text):
    from pricetide.operators.long import to_long

    path = scratch_path(spark, "t-evolve")
    long = to_long(wide_text, on_nonexistent="drop").withColumn(
        "source_key", F.format_string("daa_market.%04d-%02d", "year", "month"))
    write_long_table(long.filter("month <= 6"), path)
    write_long_table(long.filter("month > 6").withColumn("note", F.lit("v2")), path)
    merged = read_long_table(spark, path, merge_schema=True)
    assert "note" in merged.columns and merged.count() == long.count()
    assert merged.filter("month <= 6 AND note IS NOT NULL").count() == 0


def test_same_key_rewrite_replaces_rows_with_modified_after(spark, wide_text):
    import datetime as dt

    root = scratch_path(spark, "t-samekey")
    table = scratch_path(spark, "t-samekey-table")
    may = wide_text.filter(F.col("Delivery day").endswith("/05/1996"))
    write_wide_csv(may.withColumn("Hour 1", F.lit(-3.0)), root)
    ingest(spark, root, table, IngestOptions())
    assert read_current(spark, table).filter("price = -3.0").count() > 0
    seen = read_wide_csv(spark, root).agg(F.unix_micros(F.max("file_modification_time"))).first()[0]
    time.sleep(0.05)
    write_wide_csv(may, root)  # version 2 of the same month file
    after = (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=seen)).isoformat(timespec="milliseconds")
    ingest(spark, root, table, IngestOptions(), modified_after=after)
    out = read_current(spark, table)
    assert out.filter("price = -3.0").count() == 0
    assert out.select("source_key").distinct().collect()[0][0] == "daa_market.1996-05"


def test_range_sql_equals_range_read(spark, wide_text):
    from pricetide.operators.long import to_long
    from pricetide.plans.query import range_sql

    path = scratch_path(spark, "t-rangesql")
    long = to_long(wide_text, on_nonexistent="drop").withColumn(
        "source_key", F.format_string("daa_market.%04d-%02d", "year", "month"))
    write_long_table(long, path)
    name = register_table(spark, path, "energy_market_test", "r_" + path.rsplit("-", 1)[-1])
    for by, lo, hi in [("local", "1996-10-26 00:00:00", "1996-10-28 00:00:00"),
                       ("utc", "1997-03-29 22:00:00", "1997-04-01 03:00:00")]:
        a = sorted(tuple(r) for r in read_range(spark.table(name), lo, hi, by=by).select(*LONG_COLUMNS).collect())
        b = sorted(tuple(r) for r in spark.sql(range_sql(name, lo, hi, by=by)).select(*LONG_COLUMNS).collect())
        assert a == b and a


def test_ingest_job_entry_point(spark, wide_text):
    from pricetide.plans.ingest import main

    root = scratch_path(spark, "t-cli-src")
    table = scratch_path(spark, "t-cli-table")
    quarantine = scratch_path(spark, "t-cli-q")
    write_wide_csv(wide_text, root)
    main(["--source", root, "--target", table, "--quarantine", quarantine, "--on-nonexistent", "quarantine"])
    assert read_current(spark, table).count() > 0
    assert read_rejects(spark, table, quarantine).count() >= 1
