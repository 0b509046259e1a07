"""No row is lost without a trace: small hand-written files, batch and stream."""

import os

import pytest
from pyspark.sql import functions as F

from pricetide.operators.long import to_long
from pricetide.operators.quality import day_completeness, quality_report, utc_hour_gaps
from pricetide.plans.ingest import IngestOptions, ingest, read_latest
from pricetide.plans.keyed_table import read_current, read_rejects
from pricetide.plans.query import monthly_summary
from pricetide.plans.versions import read_versions, stored_watermark
from pricetide.schema import DAY_HEADER, SLOT_HEADERS
from pricetide.session import scratch_path
from pricetide.streaming.ingest_stream import run_available_now
from tests.conftest import make_wide

HEADER = ",".join([DAY_HEADER, *SLOT_HEADERS])


def line(day, price, cells=24):
    """A normal day: 3B empty."""
    values = [str(price)] * 3 + [""] + [str(price)] * 21
    return ",".join([day, *values[:cells + 1]])


def put(root, name, *lines, when=None):
    path = os.path.join(str(root), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("# comment\n" + "\n".join([HEADER, *lines]) + "\n")
    if when is not None:
        os.utime(path, (when, when))


def options(spark, **more):
    return IngestOptions(on_invalid="quarantine", on_nonexistent="quarantine",
                         quarantine_path=scratch_path(spark, "n-rejects"), **more)


def rows(spark, table):
    return read_current(spark, table)


def rejected(spark, table, opts):
    return read_rejects(spark, table, opts.quarantine_path)


BAD_LINES = [line("99/99/2024", 2.0), line("", 3.0), line("03/05/2024", 4.0).replace("4.0", "oops", 1),
             line("04/05/2024", 5.0, cells=5), line("05/05/2024", 6.0) + ",7,8",
             line("06/05/2024", "NA"), line("07/05/2024", "null").replace("null", "9.5", 1)]


@pytest.mark.parametrize("how", ["batch", "stream"])
def test_cells_in_equal_rows_written_and_quarantined(spark, tmp_path, how):
    put(tmp_path, "daa_market/2024/5/a.csv", line("01/05/2024", 1.0), *BAD_LINES)
    table, opts = scratch_path(spark, "n-table"), options(spark)
    if how == "batch":
        ingest(spark, str(tmp_path), table, opts)
    else:
        run_available_now(spark, str(tmp_path), table, scratch_path(spark, "n-ckpt"), opts)
    written = rows(spark, table)
    refused = rejected(spark, table, opts)
    by_reason = {r.reject_reason: r["count"] for r in refused.groupBy("reject_reason").count().collect()}
    assert by_reason == {"bad_delivery_day": 48, "bad_price": 1, "malformed_line": 2}
    assert written.count() == 24 + 23 + 1
    assert written.filter("timestamp is null").count() == 0
    # What was there is there to repair from.
    assert refused.filter("delivery_day_text = '99/99/2024' and cell_text = '2.0'").count() == 24
    assert refused.filter("cell_text = 'oops' and delivery_day = DATE'2024-05-03'").count() == 1
    assert refused.filter("reject_reason = 'malformed_line' and cell_text like '%,7,8'").count() == 1


@pytest.mark.parametrize("bad", BAD_LINES[:5])
def test_default_policy_raises(spark, tmp_path, bad):
    put(tmp_path, "daa_market/2024/5/a.csv", line("01/05/2024", 1.0), bad)
    with pytest.raises(Exception, match="rejected"):
        ingest(spark, str(tmp_path), scratch_path(spark, "n-table"))


def test_quarantine_needs_a_path():
    with pytest.raises(ValueError, match="quarantine_path"):
        IngestOptions(on_invalid="quarantine")


def test_unkeyed_files_and_top_folders_stay_apart(spark, tmp_path):
    for name, price in [("x.csv", 1.0), ("sub/y.csv", 2.0), ("daa_market/2024/13/z.csv", 3.0)]:
        put(tmp_path / "unkeyed", name, line("01/05/2024", price))
    assert read_latest(spark, str(tmp_path / "unkeyed")).count() == 3
    with pytest.raises(Exception, match="unkeyed_file"):
        ingest(spark, str(tmp_path / "unkeyed"), scratch_path(spark, "n-table"))
    opts = options(spark)
    put(tmp_path / "two", "daa_market/2024/5/a.csv", line("01/05/2024", 1.0))
    put(tmp_path / "two", "intraday/2024/05/a.csv", line("01/05/2024", 2.0))
    put(tmp_path / "two", "stray.csv", line("01/05/2024", 3.0))
    table = scratch_path(spark, "n-table")
    ingest(spark, str(tmp_path / "two"), table, opts)
    assert rows(spark, table).groupBy("source_key").count().orderBy("source_key").collect() == [
        ("daa_market.2024-05", 24), ("intraday.2024-05", 24)]
    stray = rejected(spark, table, opts).collect()
    assert [(r.source_key, r.reject_reason) for r in stray] == [("unkeyed", "unkeyed_file")]
    assert stray[0].cell_text == line("01/05/2024", 3.0)


def test_a_version_replaces_its_key_wholly(spark, tmp_path):
    table, opts = scratch_path(spark, "n-table"), options(spark, database="energy_market_test", table="n_whole")
    opts.table = "w_" + table.rsplit("-", 1)[-1]
    name = f"energy_market_test.{opts.table}"
    put(tmp_path, "ingest=1/daa_market/2024/5/a.csv", line("31/05/2024", 1.0), line("01/06/2024", 1.0),
        line("xx", 1.0), when=1000)
    put(tmp_path, "ingest=1/daa_market/2024/7/a.csv", line("01/07/2024", 7.0), when=1000)
    ingest(spark, str(tmp_path), table, opts)
    assert spark.table(name).count() == 72
    assert rejected(spark, table, opts).count() == 24
    # Version 2 lacks June and has no reject; the other key is not touched.
    put(tmp_path, "ingest=2/daa_market/2024/05/a.csv", line("31/05/2024", 2.0), when=2000)
    ingest(spark, str(tmp_path), table, opts)
    assert rows(spark, table).select("price").distinct().orderBy("price").collect() == [(2.0,), (7.0,)]
    assert spark.table(name).count() == rows(spark, table).count() == 48
    assert rejected(spark, table, opts).count() == 0
    # Version 3: every row is rejected.
    put(tmp_path, "ingest=3/daa_market/2024/05/a.csv", line("yy", 3.0), when=3000)
    assert ingest(spark, str(tmp_path), table, opts, new_only=True) == 1
    assert spark.table(name).select("price").distinct().collect() == [(7.0,)]
    assert rejected(spark, table, opts).count() == 24


@pytest.mark.parametrize("how", ["batch", "stream"])
def test_equal_times_and_late_versions(spark, tmp_path, how):
    table, ckpt = scratch_path(spark, "n-table"), scratch_path(spark, "n-ckpt")

    def run():
        if how == "batch":
            ingest(spark, str(tmp_path), table, new_only=True)
        else:
            run_available_now(spark, str(tmp_path), table, ckpt)
        return {r.price for r in rows(spark, table).collect()}

    put(tmp_path, "ingest=2/daa_market/2024/5/a.csv", line("01/05/2024", 1.0), when=2_000_000)
    assert run() == {1.0}
    put(tmp_path, "ingest=3/daa_market/2024/5/a.csv", line("01/05/2024", 2.0), when=2_000_000)  # same second
    assert run() == {2.0}
    put(tmp_path, "ingest=4/daa_market/2024/5/a.csv", line("01/05/2024", 9.0), when=1_000_000)  # late
    assert run() == {2.0}
    put(tmp_path, "ingest=5/daa_market/2024/6/a.csv", line("01/06/2024", 4.0), when=500_000)  # another key
    assert run() == {2.0, 4.0}
    assert read_versions(spark, table).count() == 2
    assert stored_watermark(spark, table).startswith("1970-01-24T03:33:19")


def test_an_older_file_alone_does_not_replace(spark, tmp_path):
    table = scratch_path(spark, "n-table")
    put(tmp_path / "new", "daa_market/2024/5/a.csv", line("01/05/2024", 2.0), when=2_000_000)
    put(tmp_path / "old", "daa_market/2024/5/a.csv", line("01/05/2024", 1.0), when=1_000_000)
    assert ingest(spark, str(tmp_path / "new"), table) == 1
    assert ingest(spark, str(tmp_path / "old"), table) == 0
    assert rows(spark, table).select("price").distinct().collect() == [(2.0,)]


def test_one_scan_reads_only_the_winners(spark, tmp_path):
    put(tmp_path, "ingest=1/daa_market/2024/5/a.csv", line("01/05/2024", 1.0), when=1000)
    put(tmp_path, "ingest=2/daa_market/2024/5/a.csv", line("01/05/2024", 2.0), when=2000)
    latest = read_latest(spark, str(tmp_path))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Join" not in plan
    assert len(latest.inputFiles()) == 1 and "ingest=2" in latest.inputFiles()[0]


def test_steps_are_checked_across_midnight(spark):
    day = [10.0, 10.0, 10.0, None, *[10.0] * 21]
    wide = make_wide(spark, [("01/05/2024", [*day[:24], None]), ("02/05/2024", [None, *day[1:]]),
                             ("not a day", day)])
    long = to_long(wide, on_invalid="drop")
    gaps = utc_hour_gaps(long).collect()
    assert [(str(r.delivery_day), r.step_seconds) for r in gaps] == [("2024-05-02", 3 * 3600)]
    report = {str(r.delivery_day): r for r in quality_report(wide, long).collect()}
    assert report["2024-05-02"].n_irregular_steps == 1
    assert report["None"].status == "unreadable_day" and report["None"].n_wide_rows == 1


def test_steps_and_days_across_missing_days(spark):
    day = [10.0, 10.0, 10.0, None, *[10.0] * 21]
    wide = make_wide(spark, [("29/12/2023", day), ("31/12/2023", day), ("01/03/2024", day), ("01/01/2026", day)])
    long = to_long(wide)
    gaps = {str(r.delivery_day): r.step_seconds for r in utc_hour_gaps(long).collect()}
    assert gaps == {"2023-12-31": 90_000, "2024-03-01": 60 * 86_400 + 3600, "2026-01-01": 670 * 86_400 + 3600}
    days = {str(r.delivery_day): r for r in day_completeness(long).collect()}
    assert len(days) == 735
    assert (days["2023-12-30"].status, days["2023-12-30"].n_hours) == ("missing", 0)
    assert (days["2024-03-31"].status, days["2024-03-31"].expected_hours) == ("missing", 23)
    assert {d for d, r in days.items() if r.status == "complete"} == {"2023-12-29", "2023-12-31", "2024-03-01",
                                                                      "2026-01-01"}
    wider = day_completeness(long, first="2023-12-01", last="2023-12-29").collect()
    assert [r.status for r in sorted(wider, key=lambda r: r.delivery_day)] == ["missing"] * 28 + ["complete"]
    nothing = long.filter("price < 0")
    assert day_completeness(nothing).count() == utc_hour_gaps(nothing).count() == 0
    timeless = long.limit(1).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    assert [(r.delivery_day, r.n_hours, r.status) for r in day_completeness(timeless).collect()] == [(None, 1, "no_time")]


def test_prices_are_summed_exactly(spark):
    wide = make_wide(spark, [("01/05/2024", [33.334, 33.334, 33.334, None, *[33.334] * 21])])
    got = monthly_summary(to_long(wide)).first()
    assert (got.sum_price, got.min_price, got.avg_price) == (800.016, 33.334, 33.33)
    fine = to_long(wide).withColumn("price", F.lit(1.23456789))
    with pytest.raises(Exception, match="decimal places"):
        monthly_summary(fine).collect()
