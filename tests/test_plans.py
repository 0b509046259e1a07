"""Plan-shape guards: everything stays JVM-side, aggregates combine map-side
before their shuffle, inputs are scanned once, and
range reads prune partitions and push the time filter into the scan."""

import re

from pyspark.sql import functions as F

from pricetide.operators.long import to_long
from pricetide.operators.quality import utc_hour_gaps
from pricetide.plans.query import read_range
from pricetide.plans.sink import write_long_table
from pricetide.session import scratch_path
from pricetide.sources.csv_wide import landing_lines, write_wide_csv
from pricetide.sources.file_keys import list_files
from pricetide.sources.lineitem import read_table, wide_prices, wide_prices_typed
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_derivation_aggregates_before_its_single_shuffle(spark):
    plan = _plan(wide_prices_typed(read_table(spark, SF_SMALL, "lineitem")))
    assert "partial_min" in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_flagship_is_narrow_after_the_wide_frame(spark):
    wide = wide_prices_typed(read_table(spark, SF_SMALL, "lineitem"))
    plan = _plan(to_long(wide, on_nonexistent="drop"))
    assert len(re.findall(r"Exchange ", plan)) == 1  # only the wide derivation's
    assert "Expand" in plan and "Generate" not in plan


def test_gap_check_combines_duplicates_map_side(spark):
    wide = wide_prices_typed(read_table(spark, SF_SMALL, "lineitem"))
    plan = _plan(utc_hour_gaps(to_long(wide, on_nonexistent="drop")))
    assert "partial_count" in plan


def test_landing_lines_derive_the_frame_once(spark):
    plan = _plan(landing_lines(wide_prices(read_table(spark, SF_SMALL, "lineitem"))))
    assert plan.split("Initial Plan")[0].count("FileScan parquet") == 1


def test_listing_opens_no_file(spark):
    root = scratch_path(spark, "t-plan-landing")
    write_wide_csv(wide_prices(read_table(spark, SF_SMALL, "lineitem")), root)
    plan = _plan(list_files(spark, root))
    assert "ReadSchema: struct<path:string,modificationTime:timestamp>" in plan


def test_range_read_prunes_and_pushes(spark):
    path = scratch_path(spark, "t-plan-table")
    long = to_long(wide_prices_typed(read_table(spark, SF_SMALL, "lineitem")), on_nonexistent="drop")
    write_long_table(long.withColumn("source_key", F.format_string("%04d-%02d", "year", "month")), path)
    df = read_range(spark.read.parquet(path), "1998-03-01", "1998-04-01", by="utc").select("timestamp_utc", "price")
    plan = _plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*month", plan)
    assert re.search(r"PushedFilters: \[[^\]]*timestamp_utc", plan)
    assert "ReadSchema: struct<timestamp_utc:timestamp_ntz,price:double>" in plan
