"""File keys and latest-version selection by listing.

A key is the top folder and the month, ``daa_market.2024-05``: one file key is
one unit of replacement. Files are listed (path and time only, no content),
ranked, and only the winners are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A key ends in ``<top>/<YYYY>/<M or MM>/<file>``; the year and
# month folders may also be written ``name=value`` (Hive style).
FILE_KEY_PATTERN = r"([^/]+)/(?:[^/=]+=)?([0-9]{4})/(?:[^/=]+=)?([0-9]{1,2})/[^/]+$"
UNKEYED = "unkeyed"


def parse_file_key(path: Column | str) -> dict[str, Column]:
    """``top_folder``, ``file_year``, ``file_month`` (int, so ``5`` and ``05``
    meet) and the normalised ``source_key`` ``<top>.YYYY-MM``. A path without
    these folders, or with a month outside 1-12, has no key: all are null."""
    p = F.col(path) if isinstance(path, str) else path
    year = F.regexp_extract(p, FILE_KEY_PATTERN, 2).try_cast("int")
    month = F.regexp_extract(p, FILE_KEY_PATTERN, 3).try_cast("int")
    top = F.nullif(F.regexp_extract(p, FILE_KEY_PATTERN, 1), F.lit(""))
    keyed = year.isNotNull() & month.between(1, 12)
    return {
        "top_folder": F.when(keyed, top),
        "file_year": F.when(keyed, year),
        "file_month": F.when(keyed, month),
        "source_key": F.when(keyed, F.format_string("%s.%04d-%02d", top, year, month)),
    }


def with_file_key(df: DataFrame, path_column: str = "file_path") -> DataFrame:
    cols = parse_file_key(path_column)
    return df.withColumns({"file_year": cols["file_year"], "file_month": cols["file_month"],
                           "source_key": cols["source_key"]})


def plain_path(path: Column) -> Column:
    """A path of a scan's metadata as a listing gives it: not percent-encoded,
    ``file:/`` before a local one."""
    decoded = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def listed(files: DataFrame) -> DataFrame:
    """A listing's rows as ``file_path``, ``file_modification_time``, key."""
    return with_file_key(files.select(F.regexp_replace("path", "^file:/+", "file:/").alias("file_path"),
                                      F.col("modificationTime").alias("file_modification_time")))


def listing_options(modified_after: str | None = None) -> dict[str, str]:
    opts = {"recursiveFileLookup": "true"}
    if modified_after is not None:
        opts |= {"modifiedAfter": modified_after, "timeZone": "UTC"}
    return opts


def list_files(spark: SparkSession, path: str | list[str], modified_after: str | None = None) -> DataFrame:
    """Every file under ``path``: file_path, file_modification_time and key.
    The scan prunes the content column, so no file is opened."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.format("binaryFile").options(**listing_options(modified_after))
    return listed(reader.load(paths).select("path", "modificationTime"))


def latest_files(files: DataFrame) -> DataFrame:
    """One row per ``unit``, the key or the path of a file without one: the
    newest file, by time, then path."""
    files = files.distinct().withColumn("unit", F.coalesce("source_key", "file_path"))
    w = Window.partitionBy("unit").orderBy(F.col("file_modification_time").desc(), F.col("file_path").desc())
    return files.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
