"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings this package relies on. AQE coalesces the small shuffles of the
# per-day aggregates, splits skewed partitions of rebalanced writes and turns a
# join into a broadcast only when the measured side is under the threshold.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A backfill of many small month partitions still gets parallel writers;
    # large inputs are unaffected (their partitions are far above this).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(master: str | None = None, app_name: str = "pricetide",
                  shuffle_partitions: int | None = None,
                  checkpoint_dir: str | None = None, **conf: str) -> SparkSession:
    """Session with the package defaults. On a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_DEFAULTS)
    settings.update({"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Where it is missing, a local run (tests)
    uses ``fallback`` (or a folder under /tmp) as the context's checkpoint
    folder; a cluster without the setting is refused, since a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    # local-cluster has executors of its own, so it counts as a cluster.
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(fallback or os.path.join("/tmp", "pricetide-checkpoints"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder under the shared checkpoint folder.

    Used for the landing / table folders that the self-contained queries and
    tests write; every call gets a fresh one, nothing is cleared.
    """
    root = ensure_checkpoint_dir(spark)
    return f"{root}/pricetide-scratch/{purpose}-{uuid.uuid4().hex[:12]}"


def materialize(df, spark: SparkSession, purpose: str):
    """Write ``df`` as a Parquet table in a new folder under the shared
    checkpoint folder and return a read of it: cuts the lineage of a small
    frame that several later jobs read (columnar, column-pruned re-reads;
    survives the loss of an executor, unlike a local checkpoint)."""
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.parquet(path)
