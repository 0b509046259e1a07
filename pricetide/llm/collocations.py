"""Phrase collocations from depth-truncated suffix trees, partitioned by prefix.

Every word occurrence begins a suffix: itself and the words after it in its
piece, ``MAX_WORDS`` at most. A node of the tree of all these suffixes is a
phrase, and the leaves below it add up to the phrase's occurrences.

*Vertical partitioning.* The tree is never built whole. It is cut at the prefixes
of two words; a prefix with more suffixes than a group's budget is replaced by
its extensions by one word, whose counts one more scan gives, down to
``MAX_WORDS``. The prefixes left, none above the budget, are dealt to groups (a
task's rows each) by hash, so a scan finds a suffix's group from the few prefixes
over the budget alone (fewer than 65,536 a depth, since the budget is never
under total / 65,536).

*Subtrees.* Suffixes whose first word is over the budget are counted in the
scanning task before they are shuffled, so a phrase that is a third of all text
is a few rows per task. A row holds a suffix's prefix and the words after it. Spark
sorts a group by the prefixes' hashes alone, whole numbers that need no comparing
of rows; a task reads some whole prefixes at a time and sorts what follows them,
which is their subtrees in depth-first order. A node is a run of it. A task holds
some rows and one prefix's different suffixes, whatever its group's size.

*What is left out, exactly.* A phrase never occurs more often than a word of it, so
suffixes end before a word with fewer than ``min_count`` occurrences. A bitmap of
fixed size tells these words; its false positives cost rows, never counts.

Every number is per language. Defined results: a null text is empty, a null lang
is ``und``; repeated rows count each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import slices, stored

MIN_COUNT = 30
MAX_WORDS = 4
COVERED = 80             # per cent of a phrase's occurrences inside one longer phrase
TOP = 2000
SCALE = 2_000_000
GROUP_SUFFIXES = 8 << 20  # budget of a group
DISTINCT = 1 << 19        # distinct suffixes that a scanning task counts at once
BITMAP_BITS = 1 << 25     # of the bitmap of frequent words: 4 MB at every size
MEMO_WORDS = 1 << 20
SUBTREE_BYTES = 8 << 20   # of suffixes whose subtrees a task reads at once
PIECE = 1 << 16           # texts that are Python objects at once
SEED = 42
# The characters that end a piece.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_CUTS = bytes.maketrans(PIECE_ENDS, b"\n" * len(PIECE_ENDS))
_BLANKS = bytes.maketrans(PIECE_ENDS, b" " * len(PIECE_ENDS))


def _counted(lang: str, counted: Counter, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(counted), pa.string()),
                                       pa.array(list(counted), pa.binary()),
                                       pa.array(list(counted.values()), pa.int64())], names=["lang", name, "f"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.col("text").cast("binary").alias("text")).filter("text is not null")


def _hash(lang: str, prefix: bytes) -> int:
    """Of a prefix whose every word ends in a space."""
    return xxhash.xxh64_intdigest(lang.encode() + b"\0" + prefix, SEED)


def _hash_column(lang: str, phrase: str) -> Column:
    """The same (as a signed number) of a phrase column."""
    end = F.lit(b" ")
    return F.xxhash64(F.concat(F.col(lang).cast("binary"), F.lit(b"\0"), F.col(phrase), end))


def word_counts(docs: DataFrame, min_count: int) -> DataFrame:
    """(lang, word, f) of words with ``min_count`` occurrences or more; the row
    of a null word holds the number of all word occurrences of a language."""

    def count(batches):
        found: dict[str, Counter] = defaultdict(Counter)
        totals: Counter = Counter()

        def flush():
            for lang, counted in found.items():
                yield _counted(lang, counted, "word")
            found.clear()

        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().lower().translate(_BLANKS).split()
                totals[lang] += len(words)
                found[lang].update(words)
                if len(found[lang]) > DISTINCT:
                    yield from flush()
        yield from flush()
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.nulls(len(totals), pa.binary()),
                                          pa.array(list(totals.values()), pa.int64())], names=["lang", "word", "f"])

    counted = _texts(docs).mapInArrow(count, "lang string, word binary, f long")
    summed = counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))
    return stored(summed.filter(F.col("word").isNull() | (F.col("f") >= min_count)), "words")


def _bitmap(words: DataFrame, bits: int) -> bytes:
    """One bit for each word's hash."""
    place = F.pmod(_hash_column("lang", "word"), F.lit(bits))
    rows = (words.select(place.alias("place")).groupBy(F.shiftright("place", 15).alias("page"))
                 .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(32767)).alias("bits")).collect())
    out = bytearray(max(bits // 8, 4096))
    for r in rows:
        out[r.page * 4096:(r.page + 1) * 4096] = r.bits
    return bytes(out)


class _Scan:
    """Runs of frequent words of a text, and which prefixes are over the budget."""

    def __init__(self, shared):
        self.bitmap, self.bits, self.hot = shared.value
        self.frequent: dict[str, dict[bytes, bool]] = defaultdict(dict)
        self.hot_words: dict[str, set[bytes]] = defaultdict(set)  # over the budget

    def runs(self, lang: str, text: bytes):
        known = self.frequent[lang]
        if len(known) > MEMO_WORDS:
            known.clear()
        for piece in text.lower().translate(_CUTS).split(b"\n"):
            run: list[bytes] = []
            for word in piece.split():
                keep = known.get(word)
                if keep is None:
                    h = _hash(lang, word + b" ")
                    if h in self.hot:
                        self.hot_words[lang].add(word)
                    h = (h - (1 << 64) if h >> 63 else h) % self.bits
                    keep = known[word] = bool(self.bitmap[h >> 3] >> (h & 7) & 1)
                if keep:
                    run.append(word)
                else:
                    if len(run) > 1:
                        yield run
                    run = []
            if len(run) > 1:
                yield run

    def hot_depth(self, lang: str, key: bytes) -> int:
        """How many of the key's prefixes, from the first word on, are over
        the budget."""
        depth, end = 0, 0
        while end < len(key):
            end = key.index(b" ", end) + 1
            if _hash(lang, key[:end]) not in self.hot:
                break
            depth += 1
        return depth


def _extensions(docs: DataFrame, shared, depth: int) -> DataFrame:
    """(lang, phrase, f, hash) of the phrases of ``depth + 1`` words that may be over
    the budget: their first ``depth`` words are, as is each word."""

    def count(batches):
        scan = _Scan(shared)
        found: dict[str, Counter] = defaultdict(Counter)

        def flush():
            for lang, counted in found.items():
                yield _counted(lang, counted, "phrase")
            found.clear()

        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                hot, counted = scan.hot_words[lang], found[lang]
                for run in scan.runs(lang, text.as_py()):
                    for i in range(len(run) - depth):
                        if run[i] in hot and run[i + 1] in hot and (depth == 1 or run[i + depth] in hot and scan.hot_depth(
                                lang, b" ".join(run[i:i + depth]) + b" ") == depth):
                            counted[b" ".join(run[i:i + depth + 1])] += 1
                if len(counted) > DISTINCT:
                    yield from flush()
        yield from flush()

    return (_texts(docs).mapInArrow(count, "lang string, phrase binary, f long")
            .groupBy("lang", "phrase").agg(F.sum("f").alias("f")).withColumn("hash", _hash_column("lang", "phrase")))


def _escaped(lang: str) -> bytes:
    """Between line breaks and, reversibly, without any inside."""
    return b"\n" + lang.encode("unicode_escape") + b"\n"


def _suffixes(docs: DataFrame, shared, max_words: int) -> DataFrame:
    """(suffix, n): the suffixes of two words or more, a space between words; as one
    more word the language (escaped) stands in line breaks after the prefix that a
    suffix belongs to. Equal ones that begin with a word over the budget are counted
    within a task."""

    def scan(batches):
        texts = _Scan(shared)
        found: dict[str, Counter] = defaultdict(Counter)

        def rows(keys: list[bytes], n) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(n, pa.int64())],
                                              names=["suffix", "n"])

        def flush():
            for lang, counted in found.items():
                tongue, keys = _escaped(lang), []
                for key in counted:
                    words = key.split(b" ")[:-1]
                    depth = max(2, texts.hot_depth(lang, key) + 1)
                    keys.append(b" ".join((*words[:depth], tongue, *words[depth:])))
                yield rows(keys, list(counted.values()))
            found.clear()

        for batch in slices(batches):
            keys: list[bytes] = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                hot, tongue = texts.hot_words[lang], _escaped(lang)
                for run in texts.runs(lang, text.as_py()):
                    starts = range(len(run) - 1)
                    if hot.isdisjoint(run):
                        # Those of max_words words in one go, then the shorter ones at the run's end.
                        further = (run[k:] for k in range(2, max_words))
                        keys += map(b" ".join, zip(run, run[1:], repeat(tongue), *further))
                        starts = starts[max(0, len(run) - max_words + 1):]
                    else:
                        found[lang].update([b" ".join(run[i:i + max_words]) + b" " for i in starts if run[i] in hot])
                        starts = [i for i in starts if run[i] not in hot]
                    keys += [b" ".join((run[i], run[i + 1], tongue, *run[i + 2:i + max_words])) for i in starts]
                if len(found[lang]) > DISTINCT:
                    yield from flush()
            yield rows(keys, np.ones(len(keys), np.int64))
        yield from flush()

    return _texts(docs).mapInArrow(scan, "suffix binary, n long")


def _enough(keys: list[np.ndarray], n: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the runs of rows with equal keys: which rows are in a run whose ``n`` sum
    to ``least`` or more, the first row of each such run, and its sum."""
    if not len(n):
        return np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.zeros(len(n), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    sums = np.add.reduceat(n, starts)
    kept = sums >= least
    return np.repeat(kept, np.diff(np.append(starts, len(n)))), starts[kept], sums[kept]


def _whole_prefixes(batches, size: int):
    """Tables of about ``size`` bytes that hold all rows of each of their prefix
    hashes. A hash that goes on for longer is held as its different rows."""
    held: list[pa.RecordBatch] = []
    have, limit = 0, size
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        have += batch.nbytes
        if have < limit:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        prefix = table.column(0).to_numpy()
        cut = int(np.searchsorted(prefix, prefix[-1]))
        if cut:
            yield table.slice(0, cut)
            table = table.slice(cut)
        else:
            table = (table.group_by(["prefix", "suffix"], use_threads=False).aggregate([("n", "sum")])
                     .rename_columns({"n_sum": "n"}).select(["prefix", "suffix", "n"]))
        held, have = table.to_batches(), table.nbytes
        limit = max(size, 2 * have)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _first_words(texts: pa.Array, words: int) -> pa.Array:
    """The first ``words`` words of each text, a space after each, null where it has
    fewer. A space stands before the texts."""
    found = []
    for text in texts.to_pylist():
        parts = text.split(b" ", words + 1)
        found.append(text[1:len(text) - len(parts[-1])] if len(parts) > words + 1 else None)
    return pa.array(found, pa.binary())


def _nodes(table: pa.Table, min_count: int):
    """(prefix and language, words after it, f) of the nodes with ``min_count`` occurrences of the
    subtrees below whole prefixes."""
    n = table.column(2).to_numpy()
    table = table.filter(pa.array(_enough([table.column(0).to_numpy()], n, min_count)[0]))
    if not table.num_rows:
        return
    parts = pc.split_pattern(table.column(1).combine_chunks(), b"\n", max_splits=2).flatten()
    heads, langs, tails = (parts.take(pa.array(np.arange(i, len(parts), 3))) for i in range(3))
    heads = pc.binary_join_element_wise(heads, langs, b"\n").dictionary_encode()
    tails = tails.dictionary_encode()
    # With a space after the last word, those that begin with the same words lie together.
    texts = pc.binary_join_element_wise(tails.dictionary, b"", b" ")
    sorted_tails = pc.sort_indices(texts).to_numpy()
    place = np.empty(len(sorted_tails), np.int64)
    place[sorted_tails] = np.arange(len(sorted_tails))
    head = heads.indices.to_numpy().astype(np.int64)
    tail = place[tails.indices.to_numpy()]
    order = np.argsort(head * len(place) + tail)
    head, tail, n = head[order], tail[order], table.column(2).to_numpy()[order]
    texts = texts.take(pa.array(sorted_tails))

    kept, starts, sums = _enough([head], n, min_count)
    for first, f in zip(heads.dictionary.take(pa.array(head[starts])).to_pylist(), sums.tolist()):
        yield first, b"", f
    words = 0
    while kept.any():
        # Below nodes with enough occurrences only: each node's children by their next word.
        head, tail, n = head[kept], tail[kept], n[kept]
        words += 1
        used, tail_of = np.unique(tail, return_inverse=True)
        begun = pa.chunked_array([_first_words(texts.take(pa.array(part)), words)
                                  for part in np.split(used, range(PIECE, len(used), PIECE))]).combine_chunks()
        begun = begun.dictionary_encode()
        child = begun.indices.fill_null(-1).to_numpy()[tail_of]
        longer = child >= 0
        head, tail, n, child = head[longer], tail[longer], n[longer], child[longer]
        kept, starts, sums = _enough([head, child], n, min_count)
        yield from zip(heads.dictionary.take(pa.array(head[starts])).to_pylist(),
                       begun.dictionary.take(pa.array(child[starts])).to_pylist(), sums.tolist())


def _subtrees(suffixes: DataFrame, shared, min_count: int) -> DataFrame:
    """(lang, phrase, f) of the subtrees' nodes of two words or more with
    ``min_count`` occurrences, but for prefixes over the budget: their
    suffixes lie in several groups and they are counted already."""

    def read(batches):
        scan = _Scan(shared)
        for table in _whole_prefixes(batches, SUBTREE_BYTES):
            langs: list[str] = []
            phrases: list[bytes] = []
            counts: list[int] = []
            for head, after, f in _nodes(table, min_count):
                prefix, lang = head.split(b"\n", 1)
                lang, key = lang.decode("unicode_escape"), prefix + after
                if not scan.hot or scan.hot_depth(lang, key) < key.count(b" "):
                    langs.append(lang)
                    phrases.append(key[:-1])
                    counts.append(f)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.binary()),
                                              pa.array(counts, pa.int64())], names=["lang", "phrase", "f"])

    # Prefix and language are told by their hash, which stays out of the shuffled rows. Prefixes
    # of equal hash are read together and told apart there.
    prefix = F.hash(F.substring_index(F.col("suffix").cast("string"), "\n", 2))
    dealt = suffixes.repartition(prefix).select(prefix.alias("prefix"), "suffix", "n")
    return dealt.sortWithinPartitions("prefix").mapInArrow(read, "lang string, phrase binary, f long")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                  group_suffixes: int = GROUP_SUFFIXES) -> tuple[DataFrame, DataFrame]:
    """``(counts, totals)``: (lang, phrase, words, f) of every phrase of one to
    ``max_words`` words with ``min_count`` occurrences or more, and (lang, n) of
    all word occurrences."""
    spark = docs.sparkSession
    words = word_counts(docs, min_count)
    totals = words.filter("word is null").select("lang", F.col("f").alias("n"))
    frequent = words.filter("word is not null")
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Nor more than two tasks' even share, so that groups spread evenly.
    share = 2 * total // int(spark.conf.get("spark.sql.shuffle.partitions"))
    budget = max(1, total >> 16, min(group_suffixes, share))
    bitmap = _bitmap(frequent, BITMAP_BITS)

    prefixes = frequent.select("lang", F.col("word").alias("phrase"), "f",
                               _hash_column("lang", "word").alias("hash"))
    counted, hot = [], set()
    for depth in range(1, max_words):
        over = prefixes.filter(F.col("f") > budget).select("hash").distinct()
        found = {r.hash % (1 << 64) for r in over.collect()}  # fewer than 65,536: the budget sees to it
        hot |= found
        if depth > 1:
            counted.append(prefixes.join(over, "hash", "left_semi").select("lang", "phrase", "f"))
        shared = spark.sparkContext.broadcast((bitmap, BITMAP_BITS, frozenset(hot)))
        if not found or depth == max_words - 1:
            break
        prefixes = stored(_extensions(docs, shared, depth), "prefixes")

    suffixes = _suffixes(docs, shared, max_words)
    nodes = _subtrees(suffixes, shared, min_count)
    phrases = frequent.select("lang", F.col("word").alias("phrase"), "f").unionByName(nodes)
    for more in counted:
        phrases = phrases.unionByName(more.filter(F.col("f") >= min_count))
    phrase = F.col("phrase").cast("string")
    counts = phrases.select("lang", phrase.alias("phrase"), F.size(F.split(phrase, " ")).alias("words"), "f")
    return stored(counts, "phrases"), totals


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, covered: int = COVERED,
                 top: int = TOP, group_suffixes: int = GROUP_SUFFIXES) -> DataFrame:
    """The ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n,
    score, words, cut). A phrase's score is that of its weakest cut into two
    parts; phrases of which ``covered`` per cent lie in one longer phrase are left
    out. Products are decimals of 38 digits, so they are exact beyond 64 bits."""
    counts, totals = phrase_counts(docs, min_count, max_words, group_suffixes)
    found = counts.filter("words > 1").withColumn("parts", F.split("phrase", " "))
    cuts = found.select("lang", "phrase", "words", F.col("f").alias("a"), "parts",
                        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "words", "a", "cut",
                       F.expr("concat_ws(' ', slice(parts, 1, cut))").alias("left"),
                       F.expr("concat_ws(' ', slice(parts, cut + 1, words - cut))").alias("right"))
    first = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    score = F.expr(f"CAST(CAST({SCALE} AS DECIMAL(8,0)) * CAST(a AS DECIMAL(19,0)) div "
                   "(CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0))) AS BIGINT)")
    scored = cuts.join(first, ["lang", "left"]).join(rest, ["lang", "right"]).withColumn("score", score)
    weakest = (scored.groupBy("lang", "phrase", "words", "a")
                     .agg(F.min(F.struct("score", "cut", "l", "r")).alias("w"))
                     .select("lang", "phrase", "words", "a", "w.*"))
    inside = F.expr("flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), "
                    "i -> concat_ws(' ', slice(parts, i, m)))))")
    longer = (found.filter("words > 2").select("lang", F.explode(inside).alias("phrase"), "f")
                   .groupBy("lang", "phrase").agg(F.max("f").alias("longest")))
    free = (weakest.join(longer, ["lang", "phrase"], "left")
                   .filter(f"longest is null or CAST(longest AS DECIMAL(19,0)) * 100 < "
                           f"CAST(a AS DECIMAL(19,0)) * {covered}"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = free.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "words", "cut")


def q_collocations(spark, sf_dir):
    from pricetide.llm.common import read

    return collocations(read(spark, sf_dir, "documents")).drop("words", "cut")


Q_COLLOCATIONS_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
g AS (
  SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda k: list_transform(
           range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))) AS phrase FROM p),
c AS (SELECT lang, phrase, count(*) AS f, len(string_split(phrase, ' ')) AS m FROM g GROUP BY lang, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, f AS a, m, string_split(phrase, ' ') AS w FROM c WHERE m > 1 AND f >= 30),
cut AS (SELECT *, unnest(range(1, m)) AS k FROM cand),
s AS (
  SELECT cut.lang, cut.phrase, a, k, x.f AS l, y.f AS r,
         CAST(CAST(2000000 AS HUGEINT) * a // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cut JOIN c x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:k], ' ')
           JOIN c y ON y.lang = cut.lang AND y.phrase = array_to_string(w[k + 1:cut.m], ' ')),
weak AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
part AS (
  SELECT lang, a AS longer, unnest(flatten(list_transform(range(2, m), lambda z: list_transform(
           range(1, m - z + 2), lambda i: array_to_string(w[i:i + z - 1], ' '))))) AS phrase FROM cand WHERE m > 2),
most AS (SELECT lang, phrase, max(longer) AS longer FROM part GROUP BY lang, phrase),
free AS (
  SELECT weak.* FROM weak LEFT JOIN most ON most.lang = weak.lang AND most.phrase = weak.phrase
  WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM free JOIN n USING (lang) QUALIFY rank <= 2000
"""
