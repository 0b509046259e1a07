"""Benchmark decontamination by a positional inverted index.

*Words* are lower-cased (A-Z) runs of digits, a-z and non-ASCII characters. A
*window* is ``WINDOW`` consecutive words of a benchmark item (the whole item if
it has fewer).

1. Corpus frequencies of the benchmark's terms, counted over all documents.
2. The index: per document (the index is partitioned by document) the term ->
   positions lists of benchmark terms. Every window names its two rarest terms;
   a document that holds no such pair at the window's offset cannot match and
   stores no lists.
3. Intersection, rarest term first: positions less the term's place in the item
   give the text position where the item would begin (the diagonal); the second
   rarest term's list is intersected on it, then the lists of all other words;
   runs of ``WINDOW`` consecutive words on one diagonal are exact matches.

The benchmark is handled in blocks of at most ``BLOCK_BYTES`` of text (plus one
item), so what is broadcast has a fixed bound; each block scans the documents.

Defined results: null, empty or wordless texts have no words and match
nothing; benchmark rows without id or words have no windows; rows that share an
item id count as one item; a repeated document row is reported once per row; an
empty benchmark leaves every document clean.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import slices, stored

WINDOW = 10
BLOCK_BYTES = 16 << 20
SCAN_ROWS = 64  # texts whose words a task holds at once
# Every byte that is no part of a word becomes a space, A-Z becomes a-z.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(WORD_BYTES).split()


def term_frequencies(docs: DataFrame, terms: dict[bytes, int]) -> np.ndarray:
    """Occurrences of each term over all documents, by term number."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches):
        vocabulary = known.value
        total = np.zeros(len(vocabulary) + 1, np.int64)
        for batch in slices(batches):
            for text in batch.column(0).cast(pa.binary()):
                found = words(text.as_py())
                total += np.bincount(np.fromiter(map(vocabulary.get, found, repeat(len(vocabulary))),
                                                 np.int64, len(found)), minlength=len(total))
        used = np.flatnonzero(total[:-1])
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["term", "n"])

    out = np.zeros(len(terms), np.int64)
    counted = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for row in counted.collect():  # one row per benchmark term of the block
        out[row.term] = row.n
    return out


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[int, Iterator[list[tuple]]]:
    """The number of blocks, and the items (id as text, words) of each, one
    bounded block at a time."""
    items = benchmark.filter("item_id is not null and text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))

    def each():
        for b in range(blocks):
            part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
            yield [(r.item_id, w) for r in part.orderBy("item_id", "text").toLocalIterator()
                   if (w := words(r.text.encode()))]

    return blocks, each()


def window_anchors(items: list[tuple], terms: dict[bytes, int], frequency: np.ndarray, window: int) -> list[tuple]:
    """Distinct (item, place of the window's rarest term, that term, place of
    the second rarest, that term); one-word windows name their word twice."""
    out = set()
    for number, (_, item_words) in enumerate(items):
        ids = [terms[w] for w in item_words]
        size = min(window, len(ids))
        for start in range(len(ids) - size + 1):
            order = sorted(range(start, start + size), key=lambda q: (frequency[ids[q]], q))
            first, second = order[0], order[min(1, size - 1)]
            out.add((number, first, ids[first], second, ids[second]))
    return sorted(out)


def numbered(docs: DataFrame, blocks: int) -> DataFrame:
    """(rid, doc_id, text). One block of items reads the documents once; where
    there are more, numbers are written first, so all blocks see the same."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    return rows if blocks == 1 else stored(rows, "numbered")


def positional_index(docs: DataFrame, terms: dict[bytes, int], anchors: list[tuple], slop: int = 0) -> DataFrame:
    """(rid, doc_id, n_words, postings): the lists of the documents that hold
    an anchor pair at its offset, give or take ``slop`` words."""
    pairs = defaultdict(set)
    for _, first, first_term, second, second_term in anchors:
        for shift in range(-slop, slop + 1):
            pairs[first_term].add((second - first + shift, second_term))
    first, ends, offset, other = np.zeros(len(terms) + 1, np.int64), np.zeros(len(terms) + 1, np.int64), [], []
    for term, wanted in pairs.items():
        first[term] = len(offset)
        for o, t in sorted(wanted):
            offset.append(o)
            other.append(t)
        ends[term] = len(offset)
    known = docs.sparkSession.sparkContext.broadcast(
        (terms, first, ends - first, np.array(offset, np.int64), np.array(other, np.int64)))
    lists = pa.list_(pa.struct([("term", pa.int32()), ("positions", pa.list_(pa.int32()))]))

    def scan(batches):
        vocabulary, start, many, offsets, others = known.value
        for batch in slices(batches, SCAN_ROWS):
            found, sizes = [], []
            for text in batch.column(2).cast(pa.binary()):
                w = words(text.as_py())
                found += w
                sizes.append(len(w))
            ids = np.fromiter(map(vocabulary.get, found, repeat(len(vocabulary))), np.int64, len(found))
            begin = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
            of = np.repeat(np.arange(len(sizes)), sizes)
            rare = np.flatnonzero(many[ids])
            n = many[ids[rare]]
            at = np.repeat(rare, n)
            entry = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[ids[rare]], n)
            there = at + offsets[entry]
            inside = (there >= 0) & (there < len(ids))
            there, at, entry = there[inside], at[inside], entry[inside]
            met = (of[there] == of[at]) & (ids[there] == others[entry])
            postings = [[] for _ in sizes]
            for d in np.unique(of[at[met]]).tolist():
                own = ids[begin[d]:begin[d + 1]]
                place = np.flatnonzero(own < len(vocabulary))
                place = place[np.argsort(own[place], kind="stable")]
                cut = np.flatnonzero(np.diff(own[place])) + 1
                postings[d] = [{"term": int(own[p[0]]), "positions": p} for p in np.split(place, cut)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(postings, lists)],
                names=["rid", "doc_id", "n_words", "postings"])

    kept = docs.select("rid", "doc_id", "text")
    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(scan, f"rid long, doc_id {kind}, n_words long, "
                                 "postings array<struct<term:int,positions:array<int>>>")


def occurrences(index: DataFrame) -> DataFrame:
    """(rid, term, at): the stored lists, one row per position."""
    return (index.filter(F.size("postings") > 0).select("rid", F.inline("postings"))
                 .select("rid", "term", F.explode("positions").alias("at")))


def _small(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of one benchmark block (bounded by ``BLOCK_BYTES``)."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def exact_runs(index: DataFrame, items: list[tuple], terms: dict[bytes, int], anchors: list[tuple],
               window: int = WINDOW) -> DataFrame:
    """(rid, item_id, first, last): text spans whose words are consecutive
    words of an item, a window or longer."""
    spark = index.sparkSession
    at = occurrences(index)
    pairs = _small(spark, anchors, "item int, q1 int, term int, q2 int, term2 int")
    starts = at.join(pairs, "term").select("rid", "item", (F.col("at") - F.col("q1")).alias("d"),
                                           F.col("term2").alias("term"),
                                           (F.col("at") - F.col("q1") + F.col("q2")).alias("at"))
    diagonals = starts.join(at, ["rid", "term", "at"]).select("rid", "item", "d").distinct()
    places = _small(spark, [(i, q, terms[w]) for i, (_, ws) in enumerate(items) for q, w in enumerate(ws)],
                    "item int, q int, term int")
    need = _small(spark, [(i, item_id, min(window, len(ws))) for i, (item_id, ws) in enumerate(items)],
                  "item int, item_id string, need int")
    met = (diagonals.join(places, "item")
                    .select("rid", "item", "d", "q", "term", (F.col("d") + F.col("q")).alias("at"))
                    .join(at, ["rid", "term", "at"]).select("rid", "item", "d", "q"))
    line = Window.partitionBy("rid", "item", "d").orderBy("q")  # at most an item's words
    runs = (met.withColumn("run", F.col("q") - F.row_number().over(line))
               .groupBy("rid", "item", "d", "run").agg(F.min("q").alias("q1"), F.max("q").alias("q2")))
    return (runs.join(need, "item").filter(F.col("q2") - F.col("q1") + 1 >= F.col("need"))
                .select("rid", "item_id", (F.col("d") + F.col("q1")).alias("first"),
                        (F.col("d") + F.col("q2")).alias("last")))


def exact_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(documents: rid, doc_id, n_words), (spans: rid, item_id, first, last)."""
    rows, spans = None, None
    blocks, each = benchmark_blocks(benchmark)
    docs = numbered(docs, blocks)
    for items in each:
        terms = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        anchors = window_anchors(items, terms, term_frequencies(docs, terms), window) if terms else []
        index = stored(positional_index(docs, terms, anchors), "postings")
        rows = index.select("rid", "doc_id", "n_words") if rows is None else rows
        found = exact_runs(index, items, terms, anchors, window)
        spans = found if spans is None else spans.union(found)
    return rows, spans


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slop: int, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, first, at): windows (by their first word in the item)
    all of whose words occur within ``slop`` words of their place, counted from
    ``at``, the text position of the window's rarest word."""
    spark, out = docs.sparkSession, None
    blocks, each = benchmark_blocks(benchmark)
    docs = numbered(docs, blocks)
    for items in each:
        terms = {w: i for i, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        frequency = term_frequencies(docs, terms)
        index = stored(positional_index(docs, terms, window_anchors(items, terms, frequency, window), slop),
                       "postings")
        at = occurrences(index)
        rare, others = [], []
        for i, (item_id, ws) in enumerate(items):
            ids = [terms[w] for w in ws]
            size = min(window, len(ids))
            for start in range(len(ids) - size + 1):
                q = min(range(start, start + size), key=lambda q: (frequency[ids[q]], q))
                rare.append((i, item_id, start, ids[q], size - 1))
                others += [(i, start, ids[p], p - q) for p in range(start, start + size) if p != q]
        seeds = at.join(_small(spark, rare, "item int, item_id string, first int, term int, wanted int"),
                        "term").select("rid", "item", "item_id", "first", "at", "wanted")
        # Every place at which a word may stand is looked up by itself, so a
        # word that fills a text costs no more than any other.
        places = F.explode(F.sequence(F.col("at") + F.col("off") - slop, F.col("at") + F.col("off") + slop))
        near = (seeds.join(_small(spark, others, "item int, first int, term int, off int"), ["item", "first"])
                     .withColumn("there", places)
                     .join(at.withColumnRenamed("at", "there"), ["rid", "term", "there"]))
        met = (near.groupBy("rid", "item", "first", "at").agg(F.count_distinct("off").alias("met")))
        met = (seeds.join(met, ["rid", "item", "first", "at"], "left")
                    .filter(F.coalesce("met", F.lit(0)) == F.col("wanted"))
                    .join(index.select("rid", "doc_id"), "rid").select("doc_id", "item_id", "first", "at"))
        out = met if out is None else out.union(met)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside a match),
    items (ids as text, sorted), contaminated."""
    rows, spans = exact_matches(docs, benchmark, window)
    spans = stored(spans, "matches")
    hit = (spans.select("rid", F.explode(F.sequence("first", "last")).alias("at")).distinct()
                .groupBy("rid").agg(F.count("*").alias("n_hit")))
    items = spans.groupBy("rid").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    none = F.array().cast("array<string>")
    return (rows.join(hit, "rid", "left").join(items, "rid", "left")
                .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                        F.coalesce("items", none).alias("items"), F.col("n_hit").isNotNull().alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window. Every row
    goes by its own text (matched by its SHA-256), whatever its doc_id: null, or
    one that other rows share; rows without a text stay."""
    of = F.sha2(F.col("text"), 256)
    texts = docs.select(of.alias("doc_id"), "text")
    bad = contamination(texts, benchmark, window).filter("contaminated").select(F.col("doc_id").alias("__bad"))
    return docs.join(bad.distinct(), of == F.col("__bad"), "left_anti")


def q_decontamination(spark, sf_dir):
    from pricetide.llm.common import read

    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


# Word splitting, sliding windows and an equality join, as plain SQL.
Q_DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT rid, item_id, i, dw.n FROM dw JOIN bw ON dw.gram = bw.gram AND dw.n = bw.n),
h AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS pos FROM m)
      GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN it USING (rid)
"""
