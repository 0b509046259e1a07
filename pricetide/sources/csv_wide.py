"""Wide price CSV files: scan (S1, S2) and landing writer.

Files look like the market's export: a ``#`` comment line, a header
``Delivery day,Hour 1,...,Hour 3A,Hour 3B,...,Hour 24`` and one row per
delivery day (``dd/MM/yyyy``). A month lives in one file under
``<top>/<YYYY>/<M>/``; rewritten versions replace the old one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.functions.slots import parse_delivery_day
from pricetide.sources.file_keys import plain_path
from pricetide.schema import (
    COMMENT_CHAR,
    DAY_HEADER,
    DEFAULT_TOP_FOLDER,
    SLOT_HEADERS,
    WIDE_TEXT_SCHEMA,
)

# The column of malformed lines; the comment line written at the
# top of each landing file.
MALFORMED_COLUMN = "_malformed_line"
COMMENT_LINE = "# Prices - day-ahead auction - Currency: EUR"


def csv_reader_options(modified_after: str | None = None) -> dict[str, str]:
    opts = {
        "header": "true",
        "comment": COMMENT_CHAR,
        # Check every file's header against the declared names: swapped or
        # extra columns fail instead of loading into the wrong slot.
        "enforceSchema": "false",
        # A line with too few or too many cells is kept whole in this column
        # and goes to the policy for invalid rows.
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": MALFORMED_COLUMN,
        # Month folders are read whatever their naming; the month comes from
        # the key (S3), not from folder partition discovery.
        "recursiveFileLookup": "true",
    }
    if modified_after is not None:
        opts["modifiedAfter"] = modified_after
        opts["timeZone"] = "UTC"
    return opts


def with_file_lineage(df: DataFrame) -> DataFrame:
    return df.select("*", plain_path(F.col("_metadata.file_path")).alias("file_path"),
                     F.col("_metadata.file_modification_time").alias("file_modification_time"))


def read_wide_csv(spark: SparkSession, path: str | list[str], modified_after: str | None = None,
                  schema: T.StructType = WIDE_TEXT_SCHEMA) -> DataFrame:
    """Scan wide price files (one or many, by folder or glob) as text cells,
    with ``file_path`` and ``file_modification_time`` lineage and, for a line
    with a wrong number of cells, the line itself in ``_malformed_line``.

    ``modified_after`` (``YYYY-MM-DDTHH:MM:SS[.fff]`` in UTC) keeps only files
    changed after that instant: the batch form of incremental pick-up (S8).
    Typing (day-first date, numbers) happens in :func:`annotate_long`, per
    cell, so a bad value is caught without losing the file.
    """
    schema = T.StructType([*schema.fields, T.StructField(MALFORMED_COLUMN, T.StringType())])
    reader = spark.read.schema(schema).options(**csv_reader_options(modified_after))
    paths = [path] if isinstance(path, str) else list(path)
    return with_file_lineage(reader.csv(paths))


def landing_lines(wide: DataFrame, pad_month: bool = False) -> DataFrame:
    """Text lines of the month files of a wide frame (``Delivery day`` text
    plus the 25 header-named slots): comment, header, then days in order."""
    day = parse_delivery_day(DAY_HEADER)
    month = F.month(day)
    month_key = F.lpad(month.cast("string"), 2, "0") if pad_month else month.cast("string")
    rows = wide.select(
        F.year(day).alias("file_year"), month_key.alias("file_month"), day.alias("_day"),
        F.expr("concat_ws(',', " + ", ".join(f"coalesce(CAST(`{c}` AS string), '')"
                                             for c in [DAY_HEADER] + SLOT_HEADERS) + ") AS value"),
    )
    header = ",".join([DAY_HEADER] + SLOT_HEADERS)
    # A month file is one group by its nature (a line per delivery day), so
    # comment and header are put before its lines in the same aggregation.
    lines = F.transform(F.array_sort(F.collect_list(F.struct("_day", "value"))), lambda x: x["value"])
    files = rows.groupBy("file_year", "file_month").agg(
        F.concat(F.array(F.lit(COMMENT_LINE), F.lit(header)), lines).alias("lines"))
    return files.select("file_year", "file_month", F.explode("lines").alias("value"))


def write_wide_csv(wide: DataFrame, root: str, top: str = DEFAULT_TOP_FOLDER,
                   pad_month: bool = False) -> str:
    """Write one CSV file per delivery month under
    ``root/top/file_year=YYYY/file_month=M/`` (or ``MM`` with ``pad_month``).

    A month file is a bounded group (at most 31 days + 2 lines), so all lines
    of one month leave one task, in order.
    """
    out = f"{root.rstrip('/')}/{top}"
    landing_lines(wide, pad_month).write.mode("overwrite").partitionBy("file_year", "file_month").text(out)
    return out
