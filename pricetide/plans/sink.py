"""Long table sink, catalog and schema change.

A folder written by :func:`write_long_table` holds its partitions directly. Keys
that are replaced as a whole live in the versioned table of
:mod:`pricetide.plans.keyed_table`, which is built on the functions here.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The file key first: one key's leaves lie together, so replacing it lists
# only its own folders.
PARTITION_COLUMNS = ("source_key", "year", "month")
SCHEMA_LOG = "pricetide.schema_log"
# Digits of the largest value of the whole-number types.
INTEGER_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


class SchemaChangeError(ValueError):
    """A column's new type does not fit the table, nor the table's the new."""


def _partitions(df: DataFrame) -> list[str]:
    return [c for c in PARTITION_COLUMNS if c in df.columns]


def write_long_table(long: DataFrame, path: str, mode: str = "overwrite") -> list[str]:
    """Write the long table as Parquet, partitioned by the file key
    ``source_key`` and the local ``year`` and ``month`` (S4).

    ``overwrite`` is dynamic: the leaves present in ``long`` are replaced.

    The ``rebalance`` hint shuffles by the partition columns so each task
    writes few files; AQE splits a month that holds a large share of the rows
    and merges small ones. Rows are sorted by UTC time inside each file for
    tight row-group statistics on both time columns.
    """
    parts = _partitions(long)
    out = (long.hint("rebalance", *parts)
               .sortWithinPartitions(*parts, "timestamp_utc")
               .write.mode(mode)
               .option("partitionOverwriteMode", "dynamic"))
    out.partitionBy(*parts).parquet(path)
    return parts


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


# -- schema change ------------------------------------------------------------

def widened(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type that holds every value of both and that files of either are
    read as; None where there is none. Whole numbers widen to larger ones, to
    decimals that hold their digits and, up to 32 bits, to doubles; floats to
    doubles; decimals to those of more digits before and after the point;
    dates to times without zone."""
    if old == new:
        return old
    for a, b in ((old, new), (new, old)):
        name, other = a.simpleString(), b.simpleString()
        if name in INTEGER_DIGITS:
            if INTEGER_DIGITS.get(other, 0) > INTEGER_DIGITS[name]:
                return b
            if isinstance(b, T.DoubleType) and name != "bigint":
                return b
            if isinstance(b, T.DecimalType) and b.precision - b.scale >= INTEGER_DIGITS[name]:
                return b
        if isinstance(a, T.FloatType) and isinstance(b, T.DoubleType):
            return b
        if isinstance(a, T.DateType) and isinstance(b, T.TimestampNTZType):
            return b
        if (isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType) and b.scale >= a.scale
                and b.precision - b.scale >= a.precision - a.scale):
            return b
    return None


@dataclass
class SchemaChange:
    """What a frame's columns change in a table: ``schema`` is the table's
    afterwards (columns the frame lacks stay and read as null)."""

    schema: T.StructType
    added: dict[str, str] = field(default_factory=dict)
    widened: dict[str, list[str]] = field(default_factory=dict)
    removed: list[str] = field(default_factory=list)


def compare_schema(table: T.StructType, frame: T.StructType) -> SchemaChange:
    """The change from a table's columns to a frame's; raises
    :class:`SchemaChangeError` where a column's types have no common one."""
    new = {f.name: f for f in frame.fields}
    change = SchemaChange(T.StructType([]))
    for f in table.fields:
        kind = f.dataType
        if f.name in new:
            kind = widened(f.dataType, new[f.name].dataType)
            if kind is None:
                raise SchemaChangeError(f"column {f.name}: the table has {f.dataType.simpleString()}, the new rows "
                                        f"{new[f.name].dataType.simpleString()}; neither holds the other")
            if kind != f.dataType:
                change.widened[f.name] = [f.dataType.simpleString(), kind.simpleString()]
        elif f.name not in PARTITION_COLUMNS:
            change.removed.append(f.name)
        change.schema.add(f.name, kind, True)
    known = {f.name for f in table.fields}
    for f in frame.fields:
        if f.name not in known:
            change.added[f.name] = f.dataType.simpleString()
            change.schema.add(f.name, f.dataType, True)
    return change


def conform(df: DataFrame, database: str, table: str) -> DataFrame:
    """``df`` in the types that the table will have once ``df`` is added: call
    it before anything is written. A column of a narrower type than the
    table's is cast; one that doesn't fit is refused here."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return df
    change = compare_schema(spark.table(f"`{database}`.`{table}`").schema, df.schema)
    return df.select(*[df[f.name].cast(change.schema[f.name].dataType).alias(f.name)
                       if change.schema[f.name].dataType != f.dataType else df[f.name] for f in df.schema.fields])


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def table_property(spark: SparkSession, name: str, key: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(f"key = '{key}'").collect()
    return found[0].value if found else None


def set_table_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{key}' = '{_quoted(value)}')")


def schema_log(spark: SparkSession, database: str, table: str) -> list[dict]:
    """Every change of the table's columns so far: added, widened, removed."""
    return json.loads(table_property(spark, f"`{database}`.`{table}`", SCHEMA_LOG) or "[]")


# -- catalog ------------------------------------------------------------------

def _columns_sql(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
                     if f.name not in PARTITION_COLUMNS)


def table_ddl(database: str, table: str, path: str, schema: T.StructType) -> str:
    return (f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({_columns_sql(schema)}, "
            "`source_key` STRING, `year` INT, `month` INT) "
            "USING parquet PARTITIONED BY (`source_key`, `year`, `month`) "
            f"LOCATION '{_quoted(path)}'")


def define_table(spark: SparkSession, path: str, database: str, table: str, schema: T.StructType,
                 fill: Callable[[str], None]) -> bool:
    """Create the table, or bring its columns up to date with ``schema`` in
    place (S6): new columns are added; a column that rows no longer have stays
    and reads as null; both are logged in the table's properties. A wider type
    needs a new definition: it is created beside the old, ``fill(name)`` adds its
    partitions, and it takes the table's name. Returns whether the table is
    new."""
    name = f"`{database}`.`{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if not spark.catalog.tableExists(f"{database}.{table}"):
        spark.sql(table_ddl(database, table, path, schema))
        fill(name)
        return True
    change = compare_schema(spark.table(name).schema, schema)
    log = schema_log(spark, database, table)
    gone = [c for c in change.removed if c not in _logged_as_removed(log)]
    back = [f.name for f in schema.fields if f.name in _logged_as_removed(log)]
    if change.widened:
        beside = f"{table}__next"
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{beside}`")
        spark.sql(table_ddl(database, beside, path, change.schema))
        set_table_property(spark, f"`{database}`.`{beside}`", SCHEMA_LOG, json.dumps(log))
        fill(f"`{database}`.`{beside}`")
        # Only definitions change hands: the table is external, its files stay.
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}__last`")
        spark.sql(f"ALTER TABLE {name} RENAME TO `{database}`.`{table}__last`")
        spark.sql(f"ALTER TABLE `{database}`.`{beside}` RENAME TO {name}")
        spark.sql(f"DROP TABLE `{database}`.`{table}__last`")
    elif change.added:
        new = T.StructType([change.schema[c] for c in change.added])
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns_sql(new)})")
    if change.added or change.widened or gone or back:
        log.append({"added": change.added, "widened": change.widened, "removed": gone, "returned": back})
        set_table_property(spark, name, SCHEMA_LOG, json.dumps(log))
    return False


def _logged_as_removed(log: list[dict]) -> set[str]:
    gone: set[str] = set()
    for entry in log:
        gone = (gone | set(entry["removed"])) - set(entry.get("returned", []))
    return gone


def register_table(spark: SparkSession, path: str, database: str = "energy_market",
                   table: str = "day_ahead_prices", schema: T.StructType | None = None) -> str:
    """Make a folder of :func:`write_long_table` a catalog table, or bring the
    table up to date (S5, S6): columns by :func:`define_table`, partitions by
    listing the folder."""
    from pricetide.schema import LONG_SCHEMA

    name = f"`{database}`.`{table}`"
    if not define_table(spark, path, database, table, schema or LONG_SCHEMA,
                        lambda n: spark.sql(f"MSCK REPAIR TABLE {n}")):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.sql(f"REFRESH TABLE {name}")
    return f"{database}.{table}"


def read_long_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Read the long table's folder. ``merge_schema`` opens every file's footer
    to read the union of all columns (S6); the catalog table needs no such
    pass, since new columns are added to it in place."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
