"""Streaming source of file listings in which a rewritten file is a new event.

Spark's own file source remembers paths, so it never sees a file again that is
rewritten under its path. This source (``price_file_listing``, a Python data
source) lists the folder at every trigger. Its offset is the newest (time, path)
together with the number of files and a digest of all their times and paths, so
a new, rewritten or late file makes a new offset and thereby a batch. A batch
returns the files up to its end offset, of any age or, with ``late_seconds``, not
more than that older than the start offset; which of them are new is decided by
the versions on record, so a batch that is replayed changes nothing.

The folder is listed with ``pyarrow.fs`` (file, hdfs, s3, gs, abfs) on the driver,
as Spark's file source lists it, names and times only. Like that source it
leaves out names that begin with ``_`` or ``.``.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "price_file_listing"
SCHEMA = "path string, ms long"
FILES_PER_PARTITION = 10_000


def list_folder(uri: str) -> list[tuple[int, str]]:
    """(time in ms, path) of every file below a folder."""
    from pyarrow import fs

    if uri.startswith("file:") or "://" not in uri:
        root = "/" + uri.removeprefix("file:").lstrip("/")
        store, prefix = fs.LocalFileSystem(), "file:"
    else:
        scheme, rest = uri.split("://", 1)
        store, root = fs.FileSystem.from_uri(("s3" if scheme == "s3a" else scheme) + "://" + rest)
        # What the file system's paths lack: the scheme, on HDFS also the host.
        prefix = f"{scheme}://" if root.split("/")[0] else f"{scheme}://{rest.split('/')[0]}"
    root = root.rstrip("/")
    found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    out = []
    for info in found:
        if info.type != fs.FileType.File:
            continue
        below = info.path[len(root):].strip("/").split("/")
        if not any(name.startswith(("_", ".")) for name in below):
            out.append(((info.mtime_ns or 0) // 1_000_000, prefix + info.path))
    return sorted(out)


class FileBatch(InputPartition):
    def __init__(self, files: list[tuple[int, str]]):
        super().__init__(0)
        self.files = files


class ListingReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.uri = options["path"]
        late = options.get("late_seconds")
        self.late_ms = None if late is None else int(float(late) * 1000)

    def initialOffset(self) -> dict:
        return {"ms": -1, "path": "", "files": 0, "digest": 0}

    def latestOffset(self) -> dict:
        found = list_folder(self.uri)
        if not found:
            return self.initialOffset()
        if self.late_ms is not None:
            found = [f for f in found if f[0] >= found[-1][0] - self.late_ms]
        digest = 0
        for ms, path in found:
            digest ^= zlib.crc32(f"{ms} {path}".encode()) * 0x9E3779B1 & 0xFFFFFFFFFFFF
        ms, path = found[-1]
        return {"ms": ms, "path": path, "files": len(found), "digest": digest}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files = [f for f in list_folder(self.uri) if f <= (end["ms"], end["path"])
                 and (self.late_ms is None or f[0] >= start["ms"] - self.late_ms)]
        return [FileBatch(files[i:i + FILES_PER_PARTITION]) for i in range(0, max(1, len(files)), FILES_PER_PARTITION)]

    def read(self, partition: FileBatch):
        for ms, path in partition.files:
            yield path, ms

    def commit(self, end: dict) -> None:
        """Nothing to release: the record of versions is kept by the job."""


class PriceFileListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ListingReader(self.options)


def listing_stream(spark: SparkSession, source: str, late_seconds: float | None = None) -> DataFrame:
    """Stream of (path, modificationTime) of the files below ``source``."""
    spark.dataSource.register(PriceFileListing)
    reader = spark.readStream.format(NAME).option("path", source)
    if late_seconds is not None:
        reader = reader.option("late_seconds", str(late_seconds))
    return reader.load().select("path", F.timestamp_millis("ms").alias("modificationTime"))
