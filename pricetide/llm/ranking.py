"""Ranked lexical search as an inner-product search over norm buckets.

*Vectors.* A document is the vector of its terms' impacts, whole numbers that grow
with a term's occurrences and shrink with the document's length; an item is the
vector of its terms' weights, repeats counted. A score is their inner product.
Only coordinates that an item of the block has can matter, so documents
are projected on them: products stay the same and norms get shorter.

*Statistics* (documents, terms, document frequencies) cover the whole table. One
scan counts every document's terms and stores those that a bitmap of fixed size
takes for item terms; its false positives go in the exact join by term.

*Search.* Vectors are ordered by length, longest first, and dealt to tasks as
ranges of it, cut into buckets. Items start with the k-th best score that they
reach among the ``SEED_DOCS`` longest vectors, and each task raises that bound as it
finds better ones. In a bucket, an item whose bound exceeds its length times
the bucket's longest vector (Cauchy-Schwarz) ends; otherwise the products on
its ``FOCUS`` heaviest coordinates plus the lengths of what is left of both
vectors bound every document's score. What survives is scored exactly in 64-bit
integers, and a task returns an item's best k of its documents.

Items are taken in blocks of ``BLOCK_ITEMS`` rows, or fewer where they hold over
``BLOCK_TERMS`` terms, so what a task holds of them is bounded.

Defined results: a null or empty text has no term, is no result and finds none;
every row of the items is an item of its own; rows of the documents that share a
doc_id or a text are documents of their own, those of equal score in the order of
doc_id (none last), then of their row in the table; empty tables give an empty
result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.llm.common import TEXT_BATCH_ROWS, stored

TOP = 20
BLOCK_ITEMS = 2048
BLOCK_TERMS = 1 << 18
SEED_DOCS = 4096
BUCKET_DOCS = 4096
FOCUS = 4                 # an item's heaviest coordinates, which bound its scores
BITMAP_BITS = 1 << 23     # of the bitmap of item terms: 1 MB at every size
SLACK = 1e-9              # relative, far above the rounding of a bound
SEED = 42
# Letters and digits of ASCII and every other character, in UTF-8 bytes.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms_of(text: bytes | None) -> list[bytes]:
    return TERM.findall(text.lower()) if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, item, terms, counts) of every row with a term; ``item`` numbers
    the rows."""

    def scan(batches):
        for batch in batches:
            found = [Counter(terms_of(t.as_py())) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([list(c) for c in found], pa.list_(pa.binary())),
                 pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))],
                names=["item_id", "item", "terms", "counts"])

    rows = items.select("item_id", F.monotonically_increasing_id().alias("item"),
                        F.col("text").cast("binary").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    out = rows.mapInArrow(scan, f"item_id {kind}, item long, terms array<binary>, counts array<long>")
    return stored(out.filter(F.size("terms") > 0), "item-terms", TEXT_BATCH_ROWS)


def _bitmap(terms: DataFrame, bits: int) -> bytes:
    place = F.pmod(F.xxhash64("term"), F.lit(bits))
    pages = (terms.select(place.alias("place")).groupBy(F.shiftright("place", 15).alias("page"))
                  .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(32767)).alias("bits")).collect())
    out = bytearray(max(bits // 8, 4096))
    for r in pages:
        out[r.page * 4096:(r.page + 1) * 4096] = r.bits
    return bytes(out)


def document_terms(docs: DataFrame, bitmap: bytes, bits: int = BITMAP_BITS) -> DataFrame:
    """(doc_id, row, n, terms, tfs) of every document with a term: the number of
    its terms with repeats, and those that the bitmap holds."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def scan(batches):
        bitmap = shared.value

        def held(term: bytes) -> bool:
            h = xxhash.xxh64_intdigest(term, SEED)
            h = (h - (1 << 64) if h >> 63 else h) % bits
            return bool(bitmap[h >> 3] >> (h & 7) & 1)

        for batch in batches:
            sizes, names, times = [], [], []
            for text in batch.column(2):
                found = terms_of(text.as_py())
                counted = {t: c for t, c in Counter(found).items() if held(t)}
                sizes.append(len(found))
                names.append(list(counted))
                times.append(list(counted.values()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(names, pa.list_(pa.binary())),
                 pa.array(times, pa.list_(pa.int64()))], names=["doc_id", "row", "n", "terms", "tfs"])

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"),
                       F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(scan, f"doc_id {kind}, row long, n long, terms array<binary>, tfs array<long>")
    return stored(out.filter("n > 0"), "document-terms", TEXT_BATCH_ROWS)


def weights(items: DataFrame, documents: DataFrame, n_docs: int) -> DataFrame:
    """(term, w) of item terms that some document holds, weight zero left out."""
    df = documents.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    asked = items.select(F.explode("terms").alias("term")).distinct()
    w = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    return stored(df.join(asked, "term").select("term", w.alias("w")).filter("w > 0"), "term-weights")


def item_blocks(items: DataFrame, found: DataFrame):
    """Blocks of items, read one after the other: lists of (item_id, item,
    {term: weight times count}), heaviest terms first."""
    flat = items.select("item_id", "item", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select(
        "item_id", "item", F.col("t.terms").alias("term"), F.col("t.counts").alias("times"))
    q = F.col("w") * F.col("times")
    rows = (flat.join(found, "term").groupBy("item", "item_id")
                .agg(F.sort_array(F.collect_list(F.struct(q.alias("q"), "term")), asc=False).alias("terms")))
    rows = stored(rows, "item-vectors").orderBy("item")
    block, size = [], 0
    for r in rows.toLocalIterator():  # one partition of the items at a time
        block.append((r.item_id, r.item, {bytes(t.term): t.q for t in r.terms}))
        size += len(r.terms)
        if len(block) >= BLOCK_ITEMS or size >= BLOCK_TERMS:
            yield block
            block, size = [], 0
    if block:
        yield block


class Bucket:
    """Document vectors of near-equal length, by row and by coordinate."""

    def __init__(self, ids, rows, norms, coordinates, impacts):
        self.ids, self.rows, self.norms = ids, rows, np.asarray(norms)
        sizes = np.array([len(c) for c in coordinates])
        self.start = np.concatenate(([0], np.cumsum(sizes)))
        self.coordinate = np.concatenate(coordinates).astype(np.int64)
        self.impact = np.concatenate(impacts).astype(np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(self.coordinate, kind="stable")
        self.by, self.owner, self.column = self.coordinate[order], owner[order], self.impact[order]

    def entries(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents with this coordinate and their impacts."""
        a, b = np.searchsorted(self.by, [c, c + 1])
        return self.owner[a:b], self.column[a:b]

    def survivors(self, query: dict[int, int], bound: int) -> np.ndarray:
        """Documents whose score may reach ``bound``: the products on the
        query's heaviest coordinates plus Cauchy-Schwarz on all others."""
        part, used = np.zeros(len(self.norms)), np.zeros(len(self.norms))
        rest = float(sum(q * q for q in list(query.values())[FOCUS:]))
        for c, q in list(query.items())[:FOCUS]:
            at, impact = self.entries(c)
            part[at] += float(q) * impact
            used[at] += impact.astype(float) ** 2
        left = np.sqrt(np.maximum(self.norms ** 2 - used, 0.0) * (1 + SLACK))
        top = (part + np.sqrt(rest) * left) * (1 + SLACK)
        # What the norm lost by rounding before the subtraction, at most.
        top += np.sqrt(rest * SLACK) * self.norms
        return np.flatnonzero(top >= bound)

    def scores(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact scores; ``query`` holds a weight for every coordinate."""
        if len(rows) * 4 > len(self.norms):
            return np.add.reduceat(query[self.coordinate] * self.impact, self.start[:-1])[rows]
        at = [np.arange(self.start[r], self.start[r + 1]) for r in rows]
        sizes = np.array([len(x) for x in at])
        flat = np.concatenate(at)
        return np.add.reduceat(query[self.coordinate[flat]] * self.impact[flat], np.cumsum(sizes) - sizes)


class Best:
    """The best ``k`` (score, doc_id, row) of every item so far and the score
    that a further document must reach."""

    def __init__(self, n: int, k: int, bounds: list[int]):
        self.k, self.bounds = k, list(bounds)
        self.found: list[list[tuple]] = [[] for _ in range(n)]

    def add(self, j: int, bucket: Bucket, rows: np.ndarray, scores: np.ndarray) -> None:
        keep = scores >= max(1, self.bounds[j])
        if np.count_nonzero(keep) > self.k:
            keep &= scores >= np.partition(scores, -self.k)[-self.k]
        new = [(-int(s), bucket.ids[r] is None, bucket.ids[r] or 0, bucket.rows[r])
               for s, r in zip(scores[keep].tolist(), rows[keep].tolist())]
        if new:
            self.found[j] = sorted(self.found[j] + new)[:self.k]
            if len(self.found[j]) == self.k:
                self.bounds[j] = max(self.bounds[j], -self.found[j][-1][0])


def search_bucket(bucket: Bucket, queries: list[dict[int, int]], dense: int, best: Best) -> int:
    """Add the bucket's documents to ``best``; returns how many were scored."""
    longest, scored = float(bucket.norms.max()), 0
    weight = np.zeros(dense, np.int64)
    for j, query in enumerate(queries):
        length = float(np.sqrt(float(sum(q * q for q in query.values()))))
        if length * longest * (1 + SLACK) < max(1, best.bounds[j]):
            continue
        rows = bucket.survivors(query, max(1, best.bounds[j]))
        if not len(rows):
            continue
        cs = list(query)
        weight[cs] = list(query.values())
        best.add(j, bucket, rows, bucket.scores(weight, rows))
        weight[cs] = 0
        scored += len(rows)
    return scored


def _project(documents: DataFrame, shared, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, row, norm, coordinates, impacts): document vectors on the
    coordinates of a block of items."""

    def scan(batches):
        place = shared.value[0]
        for batch in batches:
            ids, rows, norms, coordinates, impacts = [], [], [], [], []
            for doc_id, row, n, terms, tfs in zip(*(batch.column(i).to_pylist() for i in range(5))):
                own = [(place[t], tf) for t, tf in zip(terms, tfs) if t in place]
                if not own:
                    continue
                m = 12 * (100 - 25 + 25 * n * n_docs // n_terms)
                impact = [1_000_000_000 * tf // (1000 * tf + m) for _, tf in own]
                ids.append(doc_id)
                rows.append(row)
                norms.append(float(np.sqrt(float(sum(x * x for x in impact)))))
                coordinates.append([c for c, _ in own])
                impacts.append(impact)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field("doc_id").type), pa.array(rows, pa.int64()),
                 pa.array(norms, pa.float64()), pa.array(coordinates, pa.list_(pa.int32())),
                 pa.array(impacts, pa.list_(pa.int32()))],
                names=["doc_id", "row", "norm", "coordinates", "impacts"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "row", "n", "terms", "tfs").mapInArrow(
        scan, f"doc_id {kind}, row long, norm double, coordinates array<int>, impacts array<int>")


def _searched(vectors: DataFrame, shared, bounds: list[int], k: int) -> DataFrame:
    """(item, doc_id, row, score): each item's best ``k`` of every task's rows,
    whose buckets are searched from long to short."""

    def scan(batches):
        place, queries = shared.value
        best = Best(len(queries), k, bounds)
        held: list[list] = [[] for _ in range(5)]

        def search():
            bucket = Bucket(held[0], held[1], held[2], [np.array(c) for c in held[3]],
                            [np.array(x) for x in held[4]])
            search_bucket(bucket, queries, len(place), best)
            for column in held:
                column.clear()

        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for a in range(0, batch.num_rows, BUCKET_DOCS):
                part = batch.slice(a, BUCKET_DOCS)
                for column, values in zip(held, part.columns):
                    column.extend(values.to_pylist())
                if len(held[0]) >= BUCKET_DOCS:
                    search()
        if held[0]:
            search()
        if kind is None:
            return
        for j, found in enumerate(best.found):
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([j] * len(found), pa.int32()),
                     pa.array([None if none else i for _, none, i, _ in found], kind),
                     pa.array([row for *_, row in found], pa.int64()),
                     pa.array([-s for s, *_ in found], pa.int64())], names=["item", "doc_id", "row", "score"])

    doc_kind = vectors.schema["doc_id"].dataType.simpleString()
    return vectors.select("doc_id", "row", "norm", "coordinates", "impacts").mapInArrow(
        scan, f"item int, doc_id {doc_kind}, row long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of ``docs``
    (doc_id, text) for every row of ``items`` (item_id, text)."""
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError("doc_id must be an integer column")
    spark = docs.sparkSession
    asked = item_terms(items)
    bitmap = _bitmap(asked.select(F.explode("terms").alias("term")).distinct(), BITMAP_BITS)
    documents = document_terms(docs, bitmap)
    n_docs, n_terms = documents.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = weights(asked, documents, n_docs)
    kind = items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
                           docs.schema["doc_id"], T.StructField("score", T.LongType())])
    out = spark.createDataFrame([], schema)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    for block in item_blocks(asked, found):
        place: dict[bytes, int] = {}
        queries = [{place.setdefault(t, len(place)): q for t, q in terms.items()} for _, _, terms in block]
        shared = spark.sparkContext.broadcast((place, queries))
        vectors = stored(_project(documents, shared, n_docs, n_terms), "vectors", TEXT_BATCH_ROWS)
        seeds = vectors.orderBy(F.desc("norm"), "row").limit(SEED_DOCS)
        first = stored(_searched(seeds, shared, [0] * len(block), k), "seed-scores", BUCKET_DOCS)
        kth = first.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).filter(f"n >= {k}")
        bounds = [0] * len(block)
        for r in kth.collect():
            bounds[r.item] = r.s
        dealt = vectors.repartitionByRange(F.desc("norm"), "row").sortWithinPartitions(F.desc("norm"), "row")
        met = _searched(dealt, shared, bounds, k)
        ranked = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(j, b[0]) for j, b in enumerate(block)],
                                      T.StructType([T.StructField("item", T.IntegerType()),
                                                    T.StructField("item_id", kind)]))
        out = out.unionByName(stored(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"),
                                     "ranked", BUCKET_DOCS))
    return out


def q_ranked_search(spark, sf_dir):
    from pricetide.llm.common import read

    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


Q_RANKED_SEARCH_SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
i AS (
  SELECT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
tot AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM len),
it AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY item_id, term),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM it) GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, tot),
m AS (SELECT doc_id, 100 - 25 + ((25 * n * nd) // l) AS m FROM len, tot),
s AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM it JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""
