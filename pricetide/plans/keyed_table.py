"""The versioned long table: every run in a folder of its own, switched by commit.

``<target>/run=<id>/source_key=…/year=…/month=…`` holds a run's rows, and
``<quarantine>/run=<id>`` its rejects. :mod:`pricetide.plans.versions` records which run
is current for which unit; readers go by that record (:func:`read_current`,
:func:`read_rejects`) or by the catalog, whose partitions point at the current
runs' leaves and follow the record (:func:`sync_catalog`). A key's old version
stays whole, and stays the one that is read, until the commit that replaces it;
:func:`vacuum` removes what no reader goes by any more.
"""

from __future__ import annotations

import re
import time
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.plans.sink import (
    _hadoop,
    _quoted,
    conform,
    define_table,
    set_table_property,
    table_property,
    write_long_table,
)
from pricetide.plans.versions import SCHEMA, commit, current_rows, new_run, read_versions, snapshot_numbers
from pricetide.schema import LONG_SCHEMA

PARTITIONS_PER_STATEMENT = 200
KEYS_PER_LISTING = 500
SNAPSHOT = "pricetide.snapshot"
TABLE_SCHEMA = T.StructType(LONG_SCHEMA.fields + [T.StructField("source_key", T.StringType(), True)])


def run_folder(target: str, run: str) -> str:
    return f"{target.rstrip('/')}/run={run}"


def write_run(long: DataFrame, target: str, run: str) -> None:
    """A run's rows in its folder; not visible before its commit."""
    write_long_table(long, run_folder(target, run), mode="append")


def replace_keys(long: DataFrame, target: str, keys: list[str], version: str = "") -> int:
    """Write ``long`` and make it the whole content of ``keys``, also of those
    without any row in it, in one commit (for rows that come from no file;
    ``version`` orders what is written of a key). Returns the snapshot's
    number."""
    spark, run = long.sparkSession, new_run()
    write_run(long, target, run)
    units = spark.createDataFrame([(k, k, version, None, run) for k in keys], SCHEMA)
    return commit(spark, target, units)


def read_current(spark: SparkSession, target: str, schema: T.StructType = TABLE_SCHEMA) -> DataFrame:
    """The table's rows by the record: of every key the current version."""
    if not snapshot_numbers(spark, target):
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    rows = spark.read.schema(full).parquet(target)
    return current_rows(spark, target, rows, F.col("source_key")).select(*schema.names)


def read_rejects(spark: SparkSession, target: str, quarantine: str) -> DataFrame:
    """Rejects of the current version of every unit: a unit's rejects go only
    when a newer version of it is committed."""
    rows = spark.read.parquet(quarantine)
    return current_rows(spark, target, rows, F.col("unit")).drop("run")


# -- catalog ------------------------------------------------------------------

def _key_pattern(spark: SparkSession, key: str) -> str:
    """A key's folder name as a glob that matches only it."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", key):
        key = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(key)
    return re.sub(r"([{}\[\],*?\\])", r"\\\1", key)


def run_leaves(spark: SparkSession, target: str, run: str, keys: list[str]) -> set[str]:
    """``source_key=k/year=2024/month=5`` of the keys' leaves in a run."""
    jvm, root, store = _hadoop(spark, run_folder(target, run))
    leaves: set[str] = set()
    if not store.exists(root):
        return leaves
    prefix = store.getFileStatus(root).getPath().toString().rstrip("/") + "/"
    for i in range(0, len(keys), KEYS_PER_LISTING):
        names = ",".join(_key_pattern(spark, k) for k in keys[i:i + KEYS_PER_LISTING])
        below = jvm.org.apache.hadoop.fs.Path(root, f"source_key={{{names}}}/*/*")
        leaves |= {p.toString().removeprefix(prefix)
                   for p in jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(store.globStatus(below))}
    return leaves


def _partition_spec(leaf: str) -> str:
    values = dict(part.split("=", 1) for part in leaf.split("/"))
    return (f"PARTITION (`source_key`='{_quoted(unquote(values['source_key']))}', `year`={int(values['year'])}, "
            f"`month`={int(values['month'])})")


def _by_run(rows) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for r in rows:
        if r.source_key is not None and r.run is not None:
            out.setdefault(r.run, []).append(r.source_key)
    return out


def _changed(spark: SparkSession, target: str, seen: int | None, number: int) -> tuple[dict, dict]:
    """Keys whose run differs between two snapshots, by run: (before, now).
    Only they come to the driver, which writes a statement for each."""
    now = read_versions(spark, target, number).select("unit", "source_key", "run")
    if seen is None:
        return {}, _by_run(now.filter("source_key is not null").collect())
    old = read_versions(spark, target, seen).select("unit", F.col("source_key").alias("source_key"), "run")
    key = F.struct("unit", "source_key", "run")
    gone = old.withColumn("k", key).join(now.select(key.alias("k")), "k", "left_anti").collect()
    new = now.withColumn("k", key).join(old.select(key.alias("k")), "k", "left_anti").collect()
    return _by_run(gone), _by_run(new)


def _statements(spark: SparkSession, name: str, verb: str, parts: list[str], between: str) -> None:
    for i in range(0, len(parts), PARTITIONS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {name} {verb} {between.join(parts[i:i + PARTITIONS_PER_STATEMENT])}")


def _point(spark: SparkSession, name: str, target: str, before: dict, now: dict) -> None:
    """Partitions of ``now`` added, or pointed at their new leaf; those that only
    ``before`` had dropped."""
    old = {leaf for run, keys in before.items() for leaf in run_leaves(spark, target, run, keys)}
    new = {leaf: run for run, keys in now.items() for leaf in run_leaves(spark, target, run, sorted(keys))}

    def place(leaf: str) -> str:
        return f"LOCATION '{_quoted(run_folder(target, new[leaf]) + '/' + leaf)}'"

    _statements(spark, name, "ADD IF NOT EXISTS",
                [f"{_partition_spec(leaf)} {place(leaf)}" for leaf in sorted(new)], " ")
    # Also leaves that were not known before: an update that stopped half way
    # may have added them already.
    if before:
        for leaf in sorted(new):
            spark.sql(f"ALTER TABLE {name} {_partition_spec(leaf)} SET {place(leaf)}")
    _statements(spark, name, "DROP IF EXISTS", [_partition_spec(leaf) for leaf in sorted(old - set(new))], ", ")


def sync_catalog(spark: SparkSession, target: str, database: str, table: str,
                 schema: T.StructType = TABLE_SCHEMA) -> str:
    """Bring the catalog table to the newest snapshot (S5, S6). The snapshot that
    its partitions show is kept in its properties, so a run touches only what
    changed since, also where an earlier run stopped before this step."""
    name = f"`{database}`.`{table}`"

    def fill(created: str) -> None:
        number = snapshot_numbers(spark, target)[-1]
        _point(spark, created, target, *_changed(spark, target, None, number))
        set_table_property(spark, created, SNAPSHOT, str(number))

    define_table(spark, target, database, table, schema, fill)
    while True:
        found = snapshot_numbers(spark, target)
        seen = int(table_property(spark, name, SNAPSHOT) or 0)
        if seen == found[-1]:
            break
        if seen in found:
            _point(spark, name, target, *_changed(spark, target, seen, found[-1]))
        else:
            # Too old to compare: every partition anew.
            listed = [r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
            _statements(spark, name, "DROP IF EXISTS", [_partition_spec(p) for p in listed], ", ")
            _point(spark, name, target, *_changed(spark, target, None, found[-1]))
        set_table_property(spark, name, SNAPSHOT, str(found[-1]))
    spark.sql(f"REFRESH TABLE {name}")
    return f"{database}.{table}"


def checked(long: DataFrame, database: str | None, table: str | None) -> DataFrame:
    """``long`` in the table's types, before it is written."""
    return conform(long, database, table) if database and table else long


# -- removal of old versions ----------------------------------------------------

def vacuum(spark: SparkSession, target: str, quarantine: str | None = None, older_than_hours: float = 24) -> int:
    """Remove keys' folders that the record no longer names and runs that were
    never committed, once they are ``older_than_hours`` old, so that a reader
    that began before a switch can finish. A run's rejects go when no unit
    names the run. Returns the number of folders removed."""
    jvm, root, store = _hadoop(spark, target)
    before = (time.time() - 3600 * older_than_hours) * 1000
    current = read_versions(spark, target)
    path = jvm.org.apache.hadoop.fs.Path
    removed = 0

    def folders(at):
        return [s for s in store.listStatus(at) if s.isDirectory()] if store.exists(at) else []

    runs = [s for s in folders(root) if s.getPath().getName().startswith("run=")]
    for status in runs:
        run = status.getPath().getName().removeprefix("run=")
        named = {r.source_key for r in current.filter(F.col("run") == run).select("source_key").collect()}
        keys = [s for s in folders(status.getPath()) if s.getPath().getName().startswith("source_key=")]
        stale = [s for s in keys if unquote(s.getPath().getName().removeprefix("source_key=")) not in named]
        if stale and len(stale) == len(keys) and status.getModificationTime() < before:
            removed += store.delete(status.getPath(), True)
            continue
        for s in stale:
            if s.getModificationTime() < before:
                removed += store.delete(s.getPath(), True)
    if quarantine:
        _, rejects, kept = _hadoop(spark, quarantine)
        used = {r.run for r in current.select("run").distinct().collect()}
        if kept.exists(rejects):
            for s in kept.listStatus(rejects):
                name = s.getPath().getName()
                if name.startswith("run=") and name[4:] not in used and s.getModificationTime() < before:
                    removed += kept.delete(path(rejects, name), True)
    return int(removed)
