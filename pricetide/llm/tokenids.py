"""Token ids in binary shards with Elias-Fano coded document boundaries.

*Writing.* Documents are dealt to tasks by ranges of doc_id and sorted; each task
encodes its texts and streams the ids to shards of at most about
``SHARD_IDS`` ids in a shared folder, every document closed by an end id. What
the job returns is the manifest, one row per shard (file, ids, documents, first
and last doc_id). It is written before anything reads a shard and names only
shards of tasks that succeeded, so a task that is run again does no harm.

*A shard* is one concatenated array of ids (2 bytes each where the vocabulary
allows it, else 4), then two Elias-Fano sequences: the start of every document
in the array, and its doc_id relative to the shard's first. An Elias-Fano
sequence of n values up to u takes about 2 + log2(u / n) bits a value: the low
bits lie packed side by side, the high bits are a unary bit vector, and the
position of every ``STEP``-th set bit, in 32 bits, makes ``select`` a
short scan. No 64-bit table is kept; what comes before a shard is one number
that the manifest gives.

*Reading.* ``read_shards`` deals shards to tasks by their bytes and returns every
document; ``lookup`` opens only the shards whose doc_id range holds an id asked
for, finds it by binary search over ``select`` and reads its ids alone.

Shards are reached through ``pyarrow.fs``: any file system it knows by URI.

Defined results: a null or empty text is the end id alone; rows without a
doc_id come first; rows that share a doc_id follow each other by text hash, each
a document of its own; an empty table writes no shard. doc_id must be an integer
column.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.llm.common import TEXT_BATCH_ROWS, stored
from pricetide.llm.warc import open_store
from pricetide.session import scratch_path

SHARD_IDS = 32 << 20      # ids after which a task begins a new shard
SHARD_DOCS = 4 << 20
ENCODE_CHARS = 1 << 20    # characters given to the tokenizer at once
CACHE_CHARS = 8 << 20     # characters of remembered parts
READ_IDS = 4 << 20        # ids read at once
READ_BYTES = 256 << 20    # bytes of shards that one task reads
END_ID = 0
STEP = 256
MAGIC = b"EFTOKEN1"
# magic, bytes an id, documents, ids, documents without doc_id, first doc_id,
# place of the boundaries, place of the doc_ids
FOOTER = "<8sQQQQqQQ"
FOOTER_SIZE = struct.calcsize(FOOTER)
HEAD = "<QQQQ"  # of a sequence: values, low bits a value, bytes of high bits, samples
MANIFEST = ("shard string, part int, seq int, n_docs long, n_ids long, first_id long, last_id long, "
            "n_without_id long, bytes long")
PARTS = re.compile(r"(?<=\S) (?=\S)")
CLOSED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
LINES = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?]*)\n([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
# How a byte-level vocabulary writes bytes: printing characters as themselves,
# the others, in order, as the characters from 256 on.
_PRINTING = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTING)}


class EliasFano:
    """A non-decreasing sequence of non-negative integers."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        low_bits = max(0, ((int(values[-1]) + 1) // n).bit_length() - 1)
        places = (values >> low_bits) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1, np.uint8)
        bits[places] = 1
        low = np.zeros((n, low_bits), np.uint8)
        for b in range(low_bits):
            low[:, b] = (values >> b) & 1
        return cls(n, low_bits, np.packbits(low.ravel(), bitorder="little"), np.packbits(bits, bitorder="little"),
                   places[::STEP].astype(np.uint32))

    def to_bytes(self) -> bytes:
        return (struct.pack(HEAD, self.n, self.low_bits, len(self.high), len(self.samples)) + self.samples.tobytes()
                + self.high.tobytes() + self.low.tobytes())

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, n_high, n_samples = struct.unpack_from(HEAD, data)
        at = struct.calcsize(HEAD)
        samples = np.frombuffer(data, np.uint32, n_samples, at)
        at += 4 * n_samples
        high = np.frombuffer(data, np.uint8, n_high, at)
        return cls(n, low_bits, np.frombuffer(data, np.uint8, -(-n * low_bits // 8), at + n_high), high, samples)

    def _low(self, i: int) -> int:
        first, last = i * self.low_bits, (i + 1) * self.low_bits
        word = int.from_bytes(self.low[first >> 3:(last + 7) >> 3].tobytes(), "little")
        return (word >> (first & 7)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value: the i-th set bit is sought from the sample before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        left, at = i % STEP, int(self.samples[i // STEP])
        byte, skip = at >> 3, at & 7
        while True:
            ones = np.flatnonzero(np.unpackbits(self.high[byte:byte + STEP], bitorder="little")[skip:])
            if left < len(ones):
                place = byte * 8 + skip + int(ones[left])
                return ((place - i) << self.low_bits) | self._low(i)
            left, byte, skip = left - len(ones), byte + STEP, 0

    def first_not_below(self, value: int) -> int:
        """Index of the first element that is at least ``value`` (or n)."""
        a, b = 0, self.n
        while a < b:
            mid = (a + b) // 2
            if self.select(mid) < value:
                a = mid + 1
            else:
                b = mid
        return a

    def all(self) -> np.ndarray:
        """Every value."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        out = (places - np.arange(self.n)) << self.low_bits
        bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits].reshape(self.n, self.low_bits)
        for b in range(self.low_bits):
            out |= bits[:, b].astype(np.int64) << b
        return out


class ShardWriter:
    """Streams one shard; ``close`` gives its manifest values."""

    def __init__(self, store, root: str, kind: np.dtype):
        self.name = f"{uuid.uuid4().hex}.ids"
        self.out = store.open_output_stream(f"{root}/{self.name}", compression=None, buffer_size=1 << 20)
        self.kind = kind
        self.starts, self.keys = [0], []
        self.without = 0

    def add(self, key: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.starts.append(self.starts[-1] + len(ids) // self.kind.itemsize)
        if key is None:
            self.without += 1
        else:
            self.keys.append(key)

    def close(self) -> tuple:
        n_ids, n_docs = self.starts[-1], len(self.starts) - 1
        first, last = (self.keys[0], self.keys[-1]) if self.keys else (None, None)
        base = first or 0
        bounds = EliasFano.of(np.array(self.starts)).to_bytes()
        keys = EliasFano.of(np.array([k - base for k in self.keys], np.int64)).to_bytes()
        at = n_ids * self.kind.itemsize
        self.out.write(bounds + keys + struct.pack(
            FOOTER, MAGIC, self.kind.itemsize, n_docs, n_ids, self.without, base, at, at + len(bounds)))
        self.out.close()
        return self.name, n_docs, n_ids, first, last, self.without, at + len(bounds) + len(keys) + FOOTER_SIZE


class ShardReader:
    """One shard: its boundaries and doc_ids in coded form, ids read on demand."""

    def __init__(self, store, path: str):
        self.file = store.open_input_file(path)
        size = self.file.size()
        magic, width, self.n_docs, self.n_ids, self.without, self.base, bounds, keys = struct.unpack(
            FOOTER, self.file.read_at(FOOTER_SIZE, size - FOOTER_SIZE))
        if magic != MAGIC:
            raise ValueError(f"no shard of token ids: {path}")
        self.kind = np.dtype("<u2" if width == 2 else "<u4")
        self.bounds = EliasFano.from_bytes(self.file.read_at(keys - bounds, bounds))
        self.keys = EliasFano.from_bytes(self.file.read_at(size - FOOTER_SIZE - keys, keys))

    def close(self) -> None:
        self.file.close()

    def ids(self, start: int, end: int) -> np.ndarray:
        width = self.kind.itemsize
        return np.frombuffer(self.file.read_at((end - start) * width, start * width), self.kind)

    def span(self, i: int) -> tuple[int, int]:
        """Start and end of the i-th document, by two selects."""
        return self.bounds.select(i), self.bounds.select(i + 1)

    def find(self, key: int) -> list[int]:
        """Places of the documents of this doc_id."""
        i = self.keys.first_not_below(max(0, key - self.base))
        found = []
        while i < self.keys.n and self.keys.select(i) == key - self.base:
            found.append(self.without + i)
            i += 1
        return found


def splits_at_spaces(blob: str) -> bool:
    """Whether a piece always begins at a lone space between two characters
    that aren't white space, so that the parts of a text cut there have
    the ids of the whole: true of byte-level BPE without normalisation."""
    spec = json.loads(blob)
    before = spec.get("pre_tokenizer") or {}
    plain = all(" " not in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"])
                for t in spec.get("added_tokens") or [])
    return (plain and not spec.get("normalizer") and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before.get("add_prefix_space"))


class Unparted(Exception):
    """A space that is no lone one stands beside this part."""


class Parts(dict):
    """Part -> bytes of its ids after a space; an unknown part is encoded and
    remembered, up to ``CACHE_CHARS`` characters of them. A part that is empty or
    has white space at an end is never remembered: it raises ``Unparted``."""

    def __init__(self, tokenizer, code: str):
        super().__init__()
        self.tokenizer, self.merges, self.code, self.chars = tokenizer, tokenizer.model.tokenize, code, 0
        self.short: dict[str, bytes] = {"": b""}  # short pieces: marks, line breaks

    def __missing__(self, part: str) -> bytes:
        if not part or part[0].isspace() or part[-1].isspace():
            raise Unparted
        if self.chars > CACHE_CHARS:
            self.clear()
            self.chars = 0
        m = CLOSED.fullmatch(part)
        if m is None:
            lines = LINES.fullmatch(part)
            if lines:
                # One line break between two words is a piece of its own, too.
                ids = self[lines[1]] + self.piece("\n") + self.piece(lines[2]) + self.piece(lines[3])
            else:
                ids = self.whole(part)
        elif m[2]:
            # The marks that close a word are a piece of their own.
            ids = self[m[1]] + self.piece(m[2])
        else:
            ids = self.piece(" " + part)
        self[part] = ids
        self.chars += len(part)
        return ids

    def whole(self, part: str) -> bytes:
        """Ids of any part after a space, as the tokenizer itself cuts it."""
        return array(self.code, self.tokenizer.encode(" " + part, add_special_tokens=False).ids).tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of one piece, which the vocabulary's merges take as it is."""
        ids = self.short.get(piece)
        if ids is None:
            byte_level = piece.encode().decode("latin-1").translate(BYTE_CHARS)
            ids = array(self.code, [t.id for t in self.merges(byte_level)]).tobytes()
            if len(piece) < 4 and len(self.short) < 100_000:
                self.short[piece] = ids
        return ids


class Encoder:
    """Texts to the bytes of their ids; where pieces begin at spaces, part by
    part."""

    def __init__(self, tokenizer, code: str, by_parts: bool):
        self.tokenizer, self.code = tokenizer, code
        self.known = Parts(tokenizer, code) if by_parts else None

    def _ids(self, texts: list[str]):
        """Ids of each text, at most about ``ENCODE_CHARS`` characters at a time."""
        for some in _spans(texts):
            for found in self.tokenizer.encode_batch_fast(some, add_special_tokens=False):
                yield array(self.code, found.ids).tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self.known is None:
            return list(self._ids(texts))
        out, heads = [], []
        for text in texts:
            # Mostly every space is a lone one, and splitting at all is faster.
            head, *parts = text.split(" ")
            try:
                if not head or head[-1].isspace():
                    raise Unparted
                out.append(b"".join(map(self.known.__getitem__, parts)))
            except Unparted:
                head, *parts = PARTS.split(text)
                # Only the last part can have white space at its end.
                end = [self.known.whole(parts.pop())] if parts and parts[-1][-1].isspace() else []
                out.append(b"".join([*map(self.known.__getitem__, parts), *end]))
            heads.append(head)
        return [head + rest for head, rest in zip(self._ids(heads), out)]


def _spans(texts: list[str]):
    """``texts`` in lists of at most about ``ENCODE_CHARS`` characters."""
    a = 0
    while a < len(texts):
        b, chars = a, 0
        while b < len(texts) and (b == a or chars + len(texts[b]) <= ENCODE_CHARS):
            chars += len(texts[b])
            b += 1
        yield texts[a:b]
        a = b


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID,
                 specials_as_text: bool = False, shard_ids: int = SHARD_IDS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Write ``docs`` (doc_id, text) in ascending doc_id order; the stored
    manifest, with ``start`` (ids before the shard). ``specials_as_text`` encodes the
    strings of special tokens inside texts as ordinary text."""
    from tokenizers import Tokenizer

    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError("doc_id must be an integer column")
    with open(tokenizer_path, encoding="utf-8") as f:
        blob = f.read()
    size = Tokenizer.from_str(blob).get_vocab_size(with_added_tokens=True)
    code = "H" if max(size - 1, end_id) < 1 << 16 else "I"  # 2 or 4 bytes, little-endian as Spark's hosts are
    by_parts = splits_at_spaces(blob)
    shared = docs.sparkSession.sparkContext.broadcast(blob)

    def write(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer as Reader

        tokenizer = Reader.from_str(shared.value)
        tokenizer.encode_special_tokens = specials_as_text
        encode, end = Encoder(tokenizer, code, by_parts), array(code, [end_id]).tobytes()
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        part, seq, writer = TaskContext.get().partitionId(), 0, None

        def row():
            name, n_docs, n_ids, first, last, without, size = writer.close()
            return pa.RecordBatch.from_pydict(
                {"shard": [name], "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                 "n_docs": [n_docs], "n_ids": [n_ids], "first_id": pa.array([first], pa.int64()),
                 "last_id": pa.array([last], pa.int64()), "n_without_id": [without], "bytes": [size]})

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for key, ids in zip(keys, encode(texts)):
                if writer is not None and (writer.starts[-1] >= shard_ids or len(writer.starts) > shard_docs):
                    yield row()
                    seq, writer = seq + 1, None
                if writer is None:
                    writer = ShardWriter(store, root, np.dtype("<u2" if code == "H" else "<u4"))
                writer.add(key, ids + end)
        if writer is not None:
            yield row()

    # Rows that agree in doc_id and text hash are dealt by their place, so
    # copies of one row never have to meet in one task.
    order = ["doc_id", "__hash", "__place"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.xxhash64("text").alias("__hash"), F.monotonically_increasing_id().alias("__place"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return with_starts(stored(dealt.mapInArrow(write, MANIFEST), "token-shards", TEXT_BATCH_ROWS))


def with_starts(manifest: DataFrame) -> DataFrame:
    """``start`` of every shard: the ids of all shards before it, summed in two
    levels so that no task orders all shards."""
    rows = manifest.withColumn("__group", F.floor(F.col("part") / 1024))
    groups = rows.groupBy("__group").agg(F.sum("n_ids").alias("__n"))
    before = Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("__group", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__group").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    return rows.join(groups, "__group").withColumn("start", start).drop("__group", "__base")


def _dealt(manifest: DataFrame) -> DataFrame:
    """Shards in as many tasks as their bytes call for."""
    spark = manifest.sparkSession
    n, size = manifest.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = min(max(1, n), max(spark.sparkContext.defaultParallelism, -(-size // READ_BYTES)))
    return manifest.repartitionByRange(int(tasks), "part", "seq")


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the shards:
    ids of all documents before it, its ids with the end id, and the CRC-32 of
    these as little-endian unsigned 32-bit integers."""

    def read(batches):
        store, root = open_store(folder)
        for batch in batches:
            for name, base in zip(*(batch.column(i).to_pylist() for i in range(2))):
                shard = ShardReader(store, f"{root}/{name}")
                bounds, keys = shard.bounds.all(), shard.keys.all() + shard.base
                a = 0
                while a < shard.n_docs:
                    b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + READ_IDS, "right")) - 1)
                    b = min(b, a + 100_000, shard.n_docs)
                    ids = shard.ids(int(bounds[a]), int(bounds[b])).astype("<u4")
                    at = bounds[a:b + 1] - bounds[a]
                    crc = [zlib.crc32(ids[s:e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
                    skip = max(0, min(shard.without, b) - a)
                    own = pa.concat_arrays([pa.nulls(skip, pa.int64()),
                                            pa.array(keys[max(a, shard.without) - shard.without:
                                                          max(b, shard.without) - shard.without], pa.int64())])
                    yield pa.RecordBatch.from_arrays(
                        [own, pa.array(bounds[a:b] + base), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])
                    a = b
                shard.close()

    return _dealt(manifest).select("shard", "start").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(manifest: DataFrame, folder: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, start, ids) of the documents of ``doc_ids`` (a caller's list).
    Only shards that can hold one are opened, and of these only the coded
    sequences and the documents' own ids are read."""
    wanted = sorted(set(doc_ids))

    def read(batches):
        store, root = open_store(folder)
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(4)))
            for name, base, first, last in rows:
                shard = ShardReader(store, f"{root}/{name}")
                for key in (k for k in wanted if first <= k <= last):
                    for i in shard.find(key):
                        start, end = shard.span(i)
                        yield pa.RecordBatch.from_pydict(
                            {"doc_id": [key], "start": [base + start],
                             "ids": pa.array([shard.ids(start, end).astype(np.int32)], pa.list_(pa.int32()))})
                shard.close()

    asked = F.array(*[F.lit(k).cast("long") for k in wanted]) if wanted else F.array().cast("array<long>")
    holds = F.exists(asked, lambda k: k.between(F.col("first_id"), F.col("last_id")))
    return _dealt(manifest.filter(holds)).select("shard", "start", "first_id", "last_id").mapInArrow(
        read, "doc_id long, start long, ids array<int>")


def q_token_ids(spark, sf_dir):
    import public_tokenizers

    from pricetide.llm.common import read

    folder = scratch_path(spark, "token-ids")
    manifest = write_shards(read(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_shards(manifest, folder)
