"""The versioned table: rejects kept per unit, switches, rounds, two writers,
files rewritten under one path, types of columns."""

import importlib
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.plans import keyed_table, versions
from pricetide.plans.ingest import ingest
from pricetide.plans.keyed_table import read_current, read_rejects, replace_keys, run_folder, sync_catalog, vacuum
from pricetide.plans.sink import (
    SchemaChangeError,
    compare_schema,
    conform,
    register_table,
    schema_log,
    table_property,
    widened,
    write_long_table,
)
from pricetide.session import scratch_path
from pricetide.streaming.ingest_stream import run_available_now
from pricetide.streaming.listing_source import ListingReader, list_folder
from tests.test_no_loss import line, options, put

job = importlib.import_module("pricetide.plans.ingest")  # the package exports its function


def prices(spark, table):
    return sorted({r.price for r in read_current(spark, table).collect()})


def refused(spark, table, opts):
    return sorted((r.source_key, r.cell_text.split(",")[0]) for r in
                  read_rejects(spark, table, opts.quarantine_path).collect())


# -- rejects stay until their own unit is mended ----------------------------------

@pytest.mark.parametrize("how", ["batch", "stream"])
def test_a_run_keeps_the_rejects_of_others(spark, tmp_path, how):
    table, ckpt, opts = scratch_path(spark, "v-table"), scratch_path(spark, "v-ckpt"), options(spark)

    def run(source):
        if how == "batch":
            return ingest(spark, str(source), table, opts, new_only=True)
        run_available_now(spark, str(tmp_path), table, ckpt, opts)

    put(tmp_path / "a", "stray.csv", line("01/05/2024", 1.0))
    put(tmp_path / "a", "daa_market/2024/5/a.csv", line("zz", 1.0))
    run(tmp_path / "a")
    first = refused(spark, table, opts)
    assert [k for k, _ in first] == ["daa_market.2024-05"] * 24 + ["unkeyed"]
    # Another source, with and without rejects: nothing of the first is lost.
    put(tmp_path / "b", "daa_market/2024/6/a.csv", line("01/06/2024", 2.0))
    run(tmp_path / "b")
    assert refused(spark, table, opts) == first
    put(tmp_path / "b", "other.csv", line("02/05/2024", 3.0))
    run(tmp_path / "b")
    assert len(refused(spark, table, opts)) == len(first) + 1
    # Only a newer version of the key clears the key's, of the file the file's.
    put(tmp_path / "c", "daa_market/2024/5/a.csv", line("01/05/2024", 4.0))
    os.utime(tmp_path / "c/daa_market/2024/5/a.csv", (time.time() + 60, time.time() + 60))
    run(tmp_path / "c")
    assert refused(spark, table, opts) == [("unkeyed", "01/05/2024"), ("unkeyed", "02/05/2024")]
    assert prices(spark, table) == [2.0, 4.0]
    put(tmp_path / "a", "stray.csv", line("09/05/2024", 1.0))
    os.utime(tmp_path / "a/stray.csv", (time.time() + 90, time.time() + 90))
    run(tmp_path / "a")
    assert refused(spark, table, opts) == [("unkeyed", "02/05/2024"), ("unkeyed", "09/05/2024")]


def test_files_without_a_key_are_on_record(spark, tmp_path):
    table, opts = scratch_path(spark, "v-table"), options(spark)
    put(tmp_path, "odd name+%41 x.csv", line("01/05/2024", 1.0))
    assert ingest(spark, str(tmp_path), table, opts, new_only=True) == 1
    assert ingest(spark, str(tmp_path), table, opts, new_only=True) == 0
    assert refused(spark, table, opts) == [("unkeyed", "01/05/2024")]
    assert ingest(spark, str(tmp_path), table, opts) == 1  # a rerun replaces its own
    assert refused(spark, table, opts) == [("unkeyed", "01/05/2024")]


# -- the switch ---------------------------------------------------------------------

def test_readers_see_the_old_version_until_the_commit(spark, tmp_path, monkeypatch):
    table, opts = scratch_path(spark, "v-table"), options(spark, database="energy_market_test", table="x")
    opts.table = "s_" + table.rsplit("-", 1)[-1]
    name = f"energy_market_test.{opts.table}"
    put(tmp_path, "daa_market/2024/5/a.csv", line("31/05/2024", 1.0), line("01/06/2024", 1.0), when=1000)
    ingest(spark, str(tmp_path), table, opts)
    put(tmp_path, "daa_market/2024/5/a.csv", line("31/05/2024", 2.0), when=2000)

    def killed(*args, **kwargs):
        raise RuntimeError("killed")

    for module, step in [(job, "commit"), (job, "write_run")]:
        with monkeypatch.context() as m:
            m.setattr(module, step, killed)
            with pytest.raises(RuntimeError, match="killed"):
                ingest(spark, str(tmp_path), table, opts)
        assert prices(spark, table) == [1.0] and read_current(spark, table).count() == 48
        spark.sql(f"REFRESH TABLE {name}")
        assert spark.table(name).count() == 48
    # Killed after the commit: the record has the new version, the catalog the
    # whole old one; the next run brings it up to date.
    with monkeypatch.context() as m:
        m.setattr(job, "sync_catalog", killed)
        with pytest.raises(RuntimeError, match="killed"):
            ingest(spark, str(tmp_path), table, opts)
    assert prices(spark, table) == [2.0] and spark.table(name).count() == 48
    put(tmp_path, "daa_market/2024/7/a.csv", line("01/07/2024", 7.0), when=2000)
    ingest(spark, str(tmp_path), table, opts, new_only=True)
    assert sorted({r.price for r in spark.table(name).collect()}) == [2.0, 7.0]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2


def test_a_catalog_too_old_to_compare_is_built_anew(spark):
    table = scratch_path(spark, "v-table")
    name = "o_" + table.rsplit("-", 1)[-1]

    def long(price, month):
        return spark.sql(f"SELECT TIMESTAMP_NTZ'2024-0{month}-01 00:00:00' AS timestamp, "
                         f"TIMESTAMP_NTZ'2024-0{month}-01 00:00:00' AS timestamp_utc, {price}D AS price, 'z' AS timezone, "
                         f"2024 AS year, {month} AS month, 'k' AS source_key")

    replace_keys(long(1, 5), table, ["k"], "1")
    sync_catalog(spark, table, "energy_market_test", name)
    for i in range(2, 4):
        replace_keys(long(i, 4 + i), table, ["k"], str(i))
    first = versions.snapshot_numbers(spark, table)[0]
    _, root, store = versions._hadoop(spark, f"{table}/_versions")
    store.delete(spark._jvm.org.apache.hadoop.fs.Path(root, f"n{first:010d}"), False)
    sync_catalog(spark, table, "energy_market_test", name)
    assert [(r.price, r.month) for r in spark.table(f"energy_market_test.{name}").collect()] == [(3.0, 7)]
    assert spark.sql(f"SHOW PARTITIONS energy_market_test.{name}").count() == 1


def test_vacuum_removes_what_no_reader_goes_by(spark, tmp_path):
    table, opts = scratch_path(spark, "v-table"), options(spark)
    put(tmp_path, "daa_market/2024/5/a.csv", line("01/05/2024", 1.0), when=1000)
    put(tmp_path, "daa_market/2024/6/a.csv", line("01/06/2024", 1.0), line("x", 1.0), when=1000)
    ingest(spark, str(tmp_path), table, opts)
    put(tmp_path, "daa_market/2024/5/a.csv", line("01/05/2024", 2.0), when=2000)
    ingest(spark, str(tmp_path), table, opts, new_only=True)
    before = sorted(map(tuple, read_current(spark, table).collect()))
    spark.range(1).selectExpr("id", "'k' as source_key").write.partitionBy("source_key").json(run_folder(table, "rdead"))
    assert vacuum(spark, table, opts.quarantine_path) == 0  # too young
    assert vacuum(spark, table, opts.quarantine_path, older_than_hours=-1) == 2
    assert sorted(map(tuple, read_current(spark, table).collect())) == before
    assert len(refused(spark, table, opts)) == 24
    assert vacuum(spark, table, opts.quarantine_path, older_than_hours=-1) == 0


# -- two writers, rounds ------------------------------------------------------------

def units(spark, *rows):
    return spark.createDataFrame([(k, k, p, None, r) for k, p, r in rows], versions.SCHEMA)


def test_two_interleaved_commits_keep_both_keys(spark, monkeypatch):
    target = scratch_path(spark, "v-record")
    versions.commit(spark, target, units(spark, ("a", "1", "r1")))
    publish, late = versions._publish, []

    def other_first(spark, where, number, table):
        if not late:
            late.append(number)
            monkeypatch.setattr(versions, "_publish", publish)
            # Another writer takes the number in between.
            versions.commit(spark, target, units(spark, ("b", "1", "r2"), ("c", "9", "r2")))
        return publish(spark, where, number, table)

    monkeypatch.setattr(versions, "_publish", other_first)
    number = versions.commit(spark, target, units(spark, ("c", "5", "r3"), ("d", "1", "r3")))
    assert late == [2] and number == 3
    got = {r.unit: r.run for r in versions.read_versions(spark, target).collect()}
    assert got == {"a": "r1", "b": "r2", "c": "r2", "d": "r3"}  # of c the later version
    assert versions._publish(spark, target, 3, "t") is False


def test_old_snapshots_go(spark, monkeypatch):
    target = scratch_path(spark, "v-record")
    monkeypatch.setattr(versions, "KEPT_SNAPSHOTS", 2)
    for i in range(4):
        versions.commit(spark, target, units(spark, (f"k{i}", "1", f"r{i}")))
    assert versions.snapshot_numbers(spark, target) == [2, 3, 4]
    assert versions.read_versions(spark, target).count() == 4


def test_a_backfill_goes_on_after_its_last_round(spark, tmp_path, monkeypatch):
    table = scratch_path(spark, "v-table")
    for month in range(1, 8):
        put(tmp_path, f"daa_market/2024/{month}/a.csv", line(f"01/{month:02d}/2024", float(month)))
    opts = options(spark, round_units=2)
    rows, done = job.ingest_rows, []

    def two_rounds(wide, units, *args):
        if len(done) == 2:
            raise RuntimeError("killed")
        done.append(units.count())
        return rows(wide, units, *args)

    monkeypatch.setattr(job, "ingest_rows", two_rounds)
    with pytest.raises(RuntimeError, match="killed"):
        ingest(spark, str(tmp_path), table, opts, new_only=True)
    monkeypatch.setattr(job, "ingest_rows", rows)
    assert max(done) <= 2 and read_current(spark, table).count() == 24 * sum(done)
    assert ingest(spark, str(tmp_path), table, opts, new_only=True) == 7 - sum(done)
    assert prices(spark, table) == [float(m) for m in range(1, 8)]
    assert ingest(spark, str(tmp_path), table, opts, new_only=True) == 0


# -- rewritten under one path -----------------------------------------------------

def test_stream_takes_a_file_rewritten_under_its_path(spark, tmp_path):
    table, ckpt = scratch_path(spark, "v-table"), scratch_path(spark, "v-ckpt")

    def run(checkpoint=ckpt):
        run_available_now(spark, str(tmp_path), table, checkpoint)
        return prices(spark, table)

    put(tmp_path, "daa_market/2024/5/a.csv", line("01/05/2024", 1.0), when=1_000_000)
    put(tmp_path, "daa_market/2024/6/a.csv", line("01/06/2024", 6.0), when=3_000_000)
    assert run() == [1.0, 6.0]
    put(tmp_path, "daa_market/2024/5/a.csv", line("01/05/2024", 2.0), when=2_000_000)  # before the newest
    assert run() == [2.0, 6.0]
    number = versions.snapshot_numbers(spark, table)
    assert run() == [2.0, 6.0]
    # Replayed from the beginning: everything is on record already.
    assert run(scratch_path(spark, "v-ckpt")) == [2.0, 6.0]
    assert versions.snapshot_numbers(spark, table) == number


def test_listing_offsets(tmp_path):
    put(tmp_path, "x/b.csv", "l", when=2)
    put(tmp_path, "x/_tmp/c.csv", "l", when=9)
    put(tmp_path, "x/.d.csv", "l", when=9)
    reader = ListingReader({"path": str(tmp_path)})
    start, first = reader.initialOffset(), reader.latestOffset()
    assert reader.latestOffset() == first and (first["ms"], first["files"]) == (2000, 1)
    put(tmp_path, "x/a.csv", "l", when=1)  # late
    second = reader.latestOffset()
    assert second != first and second["ms"] == first["ms"]
    assert [f for p in reader.partitions(first, second) for f in p.files] == list_folder(f"file://{tmp_path}")
    assert [f[1].rsplit("/", 1)[1] for p in reader.partitions(start, second) for f in p.files] == ["a.csv", "b.csv"]
    near = ListingReader({"path": str(tmp_path), "late_seconds": "0.5"})
    assert [f[0] for p in near.partitions(first, second) for f in p.files] == [2000]
    assert ListingReader({"path": str(tmp_path / "none")}).latestOffset() == start


# -- types of columns -------------------------------------------------------------------

def frame(spark, value, month):
    return spark.sql(f"SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS timestamp, TIMESTAMP_NTZ'2024-01-01 00:00:00' "
                     f"AS timestamp_utc, 1D AS price, 'z' AS timezone, {value} AS v, 2024 AS year, {month} AS month, "
                     "'k' AS source_key")


@pytest.mark.parametrize("old,new,kind", [
    ("1", "2.5D", "double"), ("2.5D", "1", "double"), ("1", "3000000000L", "bigint"), ("3000000000L", "1", "bigint"),
    ("1.5F", "2.5D", "double"), ("1.25BD", "12345.125BD", "decimal(8,3)"),
    ("DATE'2024-01-01'", "TIMESTAMP_NTZ'2024-01-01 05:00:00'", "timestamp_ntz"), ("1", "1", "int")])
def test_wider_types_are_readable(spark, old, new, kind):
    path = scratch_path(spark, "v-types")
    name = "w_" + path.rsplit("-", 1)[-1]
    for i, value in enumerate([old, new]):
        df = conform(frame(spark, value, i + 1), "energy_market_test", name)
        write_long_table(df, path)
        register_table(spark, path, "energy_market_test", name, df.schema)
    got = spark.table(f"energy_market_test.{name}")
    assert got.schema["v"].dataType.simpleString() == kind
    want = spark.sql(f"SELECT CAST({old} AS {kind}) AS a, CAST({new} AS {kind}) AS b").first()
    assert [r.v for r in got.orderBy("month").collect()] == list(want)


@pytest.mark.parametrize("old,new", [("1", "'x'"), ("3000000000L", "2.5D"), ("1.5BD", "true")])
def test_other_types_are_refused_before_a_file_is_written(spark, tmp_path, old, new):
    path = scratch_path(spark, "v-types")
    name = "x_" + path.rsplit("-", 1)[-1]
    df = frame(spark, old, 1)
    write_long_table(df, path)
    register_table(spark, path, "energy_market_test", name, df.schema)
    with pytest.raises(SchemaChangeError, match="column v"):
        conform(frame(spark, new, 2), "energy_market_test", name)


def test_ingest_refuses_before_it_writes(spark, tmp_path):
    table, opts = scratch_path(spark, "v-table"), options(spark, database="energy_market_test", table="x")
    opts.table = "y_" + table.rsplit("-", 1)[-1]
    spark.sql("CREATE DATABASE IF NOT EXISTS energy_market_test")
    spark.sql(f"CREATE TABLE energy_market_test.{opts.table} (price STRING, source_key STRING, year INT, month INT) "
              f"USING parquet PARTITIONED BY (source_key, year, month) LOCATION '{table}'")
    put(tmp_path, "daa_market/2024/5/a.csv", line("01/05/2024", 1.0))
    with pytest.raises(SchemaChangeError):
        ingest(spark, str(tmp_path), table, opts)
    _, root, store = versions._hadoop(spark, table)
    assert not [s for s in (store.listStatus(root) if store.exists(root) else [])
                if s.getPath().getName().startswith("run=")]


def test_a_dropped_column_is_logged_and_reads_null(spark):
    path = scratch_path(spark, "v-types")
    name = "d_" + path.rsplit("-", 1)[-1]
    for month, df in [(1, frame(spark, "1", 1)), (2, frame(spark, "1", 2).drop("v")), (3, frame(spark, "1", 3).drop("v")),
                      (4, frame(spark, "2.5D", 4))]:
        df = conform(df, "energy_market_test", name)
        write_long_table(df, path)
        register_table(spark, path, "energy_market_test", name, df.schema)
    got = spark.table(f"energy_market_test.{name}").orderBy("month").collect()
    assert [r.v for r in got] == [1.0, None, None, 2.5]
    assert schema_log(spark, "energy_market_test", name) == [
        {"added": {}, "widened": {}, "removed": ["v"], "returned": []},
        {"added": {}, "widened": {"v": ["int", "double"]}, "removed": [], "returned": ["v"]}]


def test_a_wider_type_in_the_versioned_table(spark):
    path = scratch_path(spark, "v-types")
    name = "e_" + path.rsplit("-", 1)[-1]
    for i, value in enumerate(["1", "2.5D"]):
        df = conform(frame(spark, value, i + 1).withColumn("source_key", F.lit(f"k{i}")), "energy_market_test", name)
        replace_keys(df, path, [f"k{i}"], "1")
        sync_catalog(spark, path, "energy_market_test", name, df.schema)
    assert [r.v for r in spark.table(f"energy_market_test.{name}").orderBy("month").collect()] == [1.0, 2.5]
    full = f"`energy_market_test`.`{name}`"
    assert int(table_property(spark, full, keyed_table.SNAPSHOT)) == 2
    assert json.loads(table_property(spark, full, "pricetide.schema_log"))[0]["widened"] == {"v": ["int", "double"]}


def test_widening_has_no_loss():
    assert widened(T.LongType(), T.DoubleType()) is None
    assert widened(T.DecimalType(10, 2), T.DecimalType(11, 4)) is None
    assert widened(T.IntegerType(), T.DecimalType(9, 0)) is None
    assert widened(T.IntegerType(), T.DecimalType(12, 2)) == T.DecimalType(12, 2)
    change = compare_schema(T.StructType().add("a", T.IntegerType()).add("b", T.StringType()),
                            T.StructType().add("a", T.LongType()).add("c", T.DateType()))
    assert (change.widened, change.removed, change.added) == ({"a": ["int", "bigint"]}, ["b"], {"c": "date"})
