"""WARC archives, index first.

*Writing.* Each task writes its rows as WARC/1.1 records, every record a gzip
member of its own, to archives of at most about ``ARCHIVE_BYTES`` in a shared
folder. What the job returns is the index: archive, offset, length, URL, digest
and type per record. The index is written before anything reads an archive and
names only archives of tasks that succeeded; a task that is run again writes
archives of new names, and those of a lost one are never read.

*Revisits.* Of records with equal payloads of ``MIN_REVISIT`` bytes or more, that
with the smallest page_id is the response; the others are revisit records that
carry its id and digest, not the payload. The choice is made on digests; a page
itself is only joined by its id, which no group of copies makes skewed.

*Reading.* Index rows, chosen by any condition, are sorted by archive and
offset; neighbouring ranges no more than ``GAP_BYTES`` apart are read as one, up
to ``READ_BYTES`` at a time.

Archives are reached through ``pyarrow.fs``: any file system it knows by URI
(file, hdfs, s3), the same on every executor.

Defined results: a null payload is empty; a null page_id is always a response
and answers for no other; rows repeated with id and payload are one response
and its revisits; a null URL is an empty target; an empty table writes no
archive and gives an empty index.
"""

from __future__ import annotations

import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import slices, stored
from pricetide.session import scratch_path

ARCHIVE_BYTES = 256 << 20
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
MIN_REVISIT = 100
LEVEL = 1  # gzip
TASK_BYTES = 32 << 20  # compressed bytes that one task reads
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: of URLs
DATE = "1970-01-01T00:00:00Z"  # pages carry no date of their own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("page_id long, url string, record_type string, payload_digest string, refers_to long, "
         "archive string, offset long, length long")


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and its path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def one_line(value: str) -> str:
    return value.replace("\\", "\\\\").replace("\r", "\\r").replace("\n", "\\n")


def from_line(value: str) -> str:
    """What `one_line` was given."""
    return re.sub(r"\\(.)", lambda m: {"r": "\r", "n": "\n"}.get(m[1], m[1]), value)


def record_id(page_id: int | None, digest: str) -> str:
    """The same for a page's response wherever it is named."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id} {digest}')}>"


def record(page_id: int | None, url: str, kind: str, digest: str, refers_to: int | None, payload: bytes) -> bytes:
    """One WARC record as a gzip member."""
    own = record_id(page_id, digest) if kind == "response" and page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", DATE),
              ("WARC-Target-URI", one_line(url)), ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("X-Page-ID", "" if page_id is None else str(page_id)), ("Content-Type", "text/html; charset=utf-8")]
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                   ("X-Refers-To-Page-ID", str(refers_to))]
    fields.append(("Content-Length", str(len(payload))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    zipped = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return zipped.compress(head.encode() + payload + b"\r\n\r\n") + zipped.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; a length that does not match is
    an error."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(fields["Content-Length"])
    if len(rest) != size + 4:
        raise ValueError(f"record of {len(rest) - 4} bytes, {size} announced")
    return fields, rest[:size]


def record_types(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``pages`` (page_id, url, html) plus payload_digest, record_type and
    refers_to."""
    html = F.coalesce("html", F.lit(""))
    digests = pages.select("page_id", html.alias("html")).filter("page_id is not null").select(
        "page_id", F.sha2("html", 256).alias("payload_digest"), F.octet_length("html").alias("n"))
    copies = digests.filter(F.col("n") >= min_revisit).select("page_id", "payload_digest").distinct()
    # Aggregated per digest first, so a digest that a third of all pages share
    # is one row on the other side; AQE splits its pages.
    first = copies.groupBy("payload_digest").agg(F.min("page_id").alias("response"))
    known = copies.join(first, "payload_digest").select("page_id", F.col("payload_digest").alias("__digest"),
                                                        "response")
    rows = pages.select("page_id", "url", html.alias("html")).withColumn("payload_digest", F.sha2("html", 256))
    met = rows.join(known.withColumnRenamed("page_id", "__page"),
                    (F.col("page_id") == F.col("__page")) & (F.col("payload_digest") == F.col("__digest")), "left")
    again = F.row_number().over(Window.partitionBy("page_id", "payload_digest").orderBy("url")) > 1
    met = met.withColumn("again", again)
    revisit = F.col("response").isNotNull() & ((F.col("response") != F.col("page_id")) | F.col("again"))
    return met.select("page_id", "url", "html", "payload_digest",
                      F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                      F.when(revisit, F.col("response")).alias("refers_to"))


def write_archives(typed: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records; the stored index of all of them."""
    def write(batches):
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        out, name, at = None, None, 0
        try:
            for batch in slices(batches):
                rows = batch.drop_columns(["html"]).to_pydict()
                html = batch.column(batch.schema.get_field_index("html")).cast(pa.binary())
                archives, offsets, lengths = [], [], []
                for i in range(batch.num_rows):
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    kind = rows["record_type"][i]
                    member = record(rows["page_id"][i], rows["url"][i] or "", kind, rows["payload_digest"][i],
                                    rows["refers_to"][i], b"" if kind == "revisit" else html[i].as_py())
                    out.write(member)
                    archives.append(name)
                    offsets.append(at)
                    lengths.append(len(member))
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["page_id"], pa.int64()), pa.array(rows["url"], pa.string()),
                     pa.array(rows["record_type"], pa.string()), pa.array(rows["payload_digest"], pa.string()),
                     pa.array(rows["refers_to"], pa.int64()), pa.array(archives, pa.string()),
                     pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["page_id", "url", "record_type", "payload_digest", "refers_to", "archive", "offset",
                           "length"])
        finally:
            if out is not None:
                out.close()

    rows = typed.withColumn("page_id", F.col("page_id").cast("long"))
    return stored(rows.mapInArrow(write, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, digest, payload) of the records
    that ``index`` rows name, from the archives' own headers and blocks."""
    wanted = index.select("archive", "offset", "length")
    # The index is small beside what it names: tasks are counted by the bytes
    # to read, at least one for each core while records last.
    n, size = wanted.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    cores = index.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(n, max(cores, -(-size // TASK_BYTES))))
    wanted = wanted.repartitionByRange(int(tasks), "archive", "offset").sortWithinPartitions("archive", "offset")

    def read(batches):
        store, root = open_store(folder)
        opened, name = None, None
        try:
            for batch in slices(batches):
                rows = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
                i = 0
                while i < len(rows):
                    archive, start, length = rows[i]
                    j, end = i + 1, start + length
                    while (j < len(rows) and rows[j][0] == archive and 0 <= rows[j][1] - end <= GAP_BYTES
                           and rows[j][1] + rows[j][2] - start <= READ_BYTES):
                        end = rows[j][1] + rows[j][2]
                        j += 1
                    if archive != name:
                        if opened is not None:
                            opened.close()
                        opened, name = store.open_input_file(f"{root}/{archive}"), archive
                    data = opened.read_at(end - start, start)
                    cols: list[list] = [[] for _ in range(6)]
                    for _, at, n in rows[i:j]:
                        fields, block = parse(data[at - start:at - start + n])
                        page, refers = fields["X-Page-ID"], fields.get("X-Refers-To-Page-ID")
                        for col, value in zip(cols, (int(page) if page else None, from_line(fields["WARC-Target-URI"]),
                                                     fields["WARC-Type"], int(refers) if refers else None,
                                                     fields["WARC-Payload-Digest"].partition(":")[2], block)):
                            col.append(value)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int64(),
                                                               pa.string(), pa.binary()))],
                        names=["page_id", "url", "record_type", "refers_to", "digest", "payload"])
                    i = j
        finally:
            if opened is not None:
                opened.close()

    return wanted.mapInArrow(read, "page_id long, url string, record_type string, refers_to long, digest string, "
                                   "payload binary")


def payload_facts(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), a
    revisit's payload taken from the response that it names. Every digest is
    computed from the payload read and must be the one its header gives."""
    seen = records.select("page_id", "record_type", "refers_to", "digest",
                          F.octet_length("payload").cast("long").alias("n"), F.sha2("payload", 256).alias("sha"))
    seen = stored(seen, "warc-records")
    checked = F.when(F.col("sha") == F.col("digest"), F.col("sha")).otherwise(
        F.raise_error(F.concat(F.lit("payload digest differs, page "), F.col("page_id").cast("string"))))
    responses = seen.filter("record_type = 'response'").select(
        "page_id", F.col("n").alias("payload_bytes"), checked.alias("payload_digest"), "record_type", "refers_to")
    by_page = responses.select(F.col("page_id").alias("__page"), F.col("payload_digest").alias("__digest"),
                               "payload_bytes").distinct()
    revisits = (seen.filter("record_type = 'revisit'")
                    .join(by_page, (F.col("refers_to") == F.col("__page")) & (F.col("digest") == F.col("__digest")),
                          "left")
                    .select("page_id", "payload_bytes", F.col("__digest").alias("payload_digest"), "record_type",
                            "refers_to"))
    return responses.unionByName(revisits)


def q_warc(spark, sf_dir):
    from pricetide.llm.common import read

    folder = scratch_path(spark, "warc")
    index = write_archives(record_types(read(spark, sf_dir, "pages")), folder)
    return payload_facts(read_records(index, folder))


Q_WARC_SQL = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
f AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND p.n >= 100
"""
