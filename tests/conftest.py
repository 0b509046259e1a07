import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricetide.schema import DAY_HEADER, SLOT_HEADERS  # noqa: E402
from pricetide.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Tests set their own checkpoint folder only because none is configured
    # for a local run; a cluster's spark.checkpoint.dir always wins.
    fallback = tempfile.mkdtemp(prefix="pricetide-tests-")
    session = build_session("local[*]", app_name="pricetide-tests", shuffle_partitions=8,
                            checkpoint_dir=fallback)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["UTC", "America/New_York"])
def session_tz(request, spark):
    """Run a test under two session time zones: results must not change."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", old)


WIDE_DDL = ", ".join([f"`{DAY_HEADER}` string"] + [f"`{h}` double" for h in SLOT_HEADERS])


def make_wide(spark, rows):
    """rows: list of (day text, list of 25 prices or None)."""
    data = [tuple([day] + list(prices)) for day, prices in rows]
    return spark.createDataFrame(data, WIDE_DDL)
