"""Which version of every unit is current: one record for batch and stream.

A unit is what one file replaces as a whole: a key (``daa_market.2024-05``), or a
file without a key by its path. A snapshot is one row per unit with its file,
the file's time and the *run* whose folder holds the unit's rows and rejects.
Snapshots are tables under ``<target>/_versions``; a small file ``n<number>`` names
the table of each number. A commit writes the merged table, then publishes its
number by a rename that fails where the number exists (compare and set: atomic on
HDFS and other file systems whose rename refuses an existing name); a run that
comes second merges with what came first and takes the next number. So nothing
that a run wrote is visible before its commit, and all of it is afterwards.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.plans.sink import _hadoop

SCHEMA = "unit string, source_key string, file_path string, file_modification_time timestamp, run string"
KEPT_SNAPSHOTS = 10
COMMIT_ATTEMPTS = 50


def new_run() -> str:
    """Name of a run's folders; never read as a number."""
    return f"r{uuid.uuid4().hex[:16]}"


def _root(target: str) -> str:
    return f"{target.rstrip('/')}/_versions"


def snapshot_numbers(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the published snapshots, ascending."""
    _, root, store = _hadoop(spark, _root(target))
    if not store.exists(root):
        return []
    names = [s.getPath().getName() for s in store.listStatus(root)]
    return sorted(int(n[1:]) for n in names if n[0] == "n" and n[1:].isdigit())


def _table_of(spark: SparkSession, target: str, number: int) -> str:
    jvm, root, store = _hadoop(spark, _root(target))
    stream = store.open(jvm.org.apache.hadoop.fs.Path(root, f"n{number:010d}"))
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_versions(spark: SparkSession, target: str, number: int | None = None) -> DataFrame:
    """The snapshot of this number, or the newest; empty before the first run."""
    if number is None:
        found = snapshot_numbers(spark, target)
        if not found:
            return spark.createDataFrame([], SCHEMA)
        number = found[-1]
    return spark.read.schema(SCHEMA).parquet(f"{_root(target)}/{_table_of(spark, target, number)}")


def _publish(spark: SparkSession, target: str, number: int, table: str) -> bool:
    """Give ``table`` this number; False where the number is taken."""
    jvm, root, store = _hadoop(spark, _root(target))
    path = jvm.org.apache.hadoop.fs.Path
    ready, name = path(root, f".{uuid.uuid4().hex}"), path(root, f"n{number:010d}")
    out = store.create(ready, True)
    out.writeBytes(table)
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(root.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(context.makeQualified(ready), context.makeQualified(name), no_options)
        return True
    except Py4JJavaError as error:
        store.delete(ready, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise


def commit(spark: SparkSession, target: str, units: DataFrame) -> int:
    """Put ``units`` (of ``SCHEMA``, one row per unit) on record; returns the
    snapshot's number. Of two versions of a unit the later by (time, path)
    stays; the same version written again replaces itself."""
    jvm, root, store = _hadoop(spark, _root(target))
    for _ in range(COMMIT_ATTEMPTS):
        found = snapshot_numbers(spark, target)
        number = found[-1] + 1 if found else 1
        table = f"t{number:010d}-{uuid.uuid4().hex[:12]}"
        rows = units.withColumn("_new", F.lit(1))
        if found:
            rows = rows.unionByName(read_versions(spark, target, found[-1]).withColumn("_new", F.lit(0)))
        columns = ["source_key", "file_path", "file_modification_time", "run"]
        merged = (rows.groupBy("unit")
                      .agg(F.max_by(F.struct(*columns), F.struct("file_modification_time", "file_path", "_new"))
                            .alias("v")).select("unit", "v.*"))
        merged.write.parquet(f"{_root(target)}/{table}")
        if _publish(spark, target, number, table):
            for old in found[:-KEPT_SNAPSHOTS]:
                store.delete(jvm.org.apache.hadoop.fs.Path(root, _table_of(spark, target, old)), True)
                store.delete(jvm.org.apache.hadoop.fs.Path(root, f"n{old:010d}"), False)
            return number
        store.delete(jvm.org.apache.hadoop.fs.Path(root, table), True)
    raise RuntimeError(f"{COMMIT_ATTEMPTS} commits to {target} met another writer's")


def not_older(files: DataFrame, versions: DataFrame, equal: bool) -> DataFrame:
    """``files`` that come after what is on record for their unit, by (time,
    path); with ``equal`` also the recorded file itself (a rerun)."""
    known = versions.select("unit", F.struct("file_modification_time", "file_path").alias("_known"))
    this = F.struct("file_modification_time", "file_path")
    later = (this >= F.col("_known")) if equal else (this > F.col("_known"))
    return (files.join(known, "unit", "left")
                 .filter(F.col("_known").isNull() | later).drop("_known"))


def stored_watermark(spark: SparkSession, target: str) -> str | None:
    """For ``modified_after``, in UTC: one second before the newest ingested
    file, so files of that same second are listed again and told apart by
    their versions. None before the first run."""
    newest = read_versions(spark, target).agg(F.max("file_modification_time").alias("t"))
    text = F.date_format(F.to_utc_timestamp(F.col("t") - F.expr("INTERVAL 1 SECOND"),
                                            F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")
    return newest.select(text).first()[0]


def current_rows(spark: SparkSession, target: str, rows: DataFrame, unit) -> DataFrame:
    """``rows`` (with a ``run`` column) of the current version of their unit.
    ``run`` is a partition column, so folders of other runs are pruned."""
    current = read_versions(spark, target).select(F.col("unit").alias("_unit"), F.col("run").alias("_run"))
    return rows.join(current, (rows["run"] == F.col("_run")) & (unit == F.col("_unit")), "left_semi")
