"""Toxic passages by maximum-scoring segments.

1. *Token log-odds with Dirichlet priors.* A token's toxic share is smoothed
   along a chain of priors: all tokens -> words with its first 3 letters ->
   first 4 -> first 6 -> the word itself. Counts are documents (a word counts
   once per document), one entry for every word and prefix under a 64-bit key, so
   no two share a count. At most ``TRAIN_DOCS`` labelled documents are counted, by
   hash order, so the broadcast model (16 bytes an entry) holds the words of
   that many texts and doesn't grow with the corpus. A token's score is its log-odds against the background less ``DRIFT``, so that clean
   text scores negative on average.
2. *Maximum-scoring segments.* One linear scan finds all maximal segments of a
   whole text (each disjoint, none extendable); runs of negative tokens are
   folded first. The scan runs on the tokens' scores as they are. A found
   segment's score is then damped by its own repeats: by the share that its
   positive scores keep if a word's k-th use within the segment counts 1/k.
   Nothing outside a segment bears on it.
3. *Extreme-value calibration.* The largest segment of a clean text of n tokens
   follows P(S <= x) = exp(-K n e^(-lambda x)); K and lambda are fitted on clean
   labelled documents, from their segments above ``FIT_ABOVE``, where the law
   holds. A segment of any score is significant by lambda S > max(0, ln(K n));
   what it exceeds that by, summed over a document's segments, is its
   evidence, turned into a probability by a logistic curve fitted on labelled
   documents that no count has seen.

Labelled rows are split by a hash of the text's id: three quarters train the
counts, one quarter (``CALIBRATE_DOCS`` at most) fits the calibration. Texts, not labels or ids, are scored.

Defined results: null or empty texts have no token and no evidence; a null
label or a label without a document teaches nothing; a document with several
label rows is toxic if one says so; with no labels at all every text scores 0.
Repeated rows are scored alike, one result each.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.llm.common import id_bucket, slices, stored

PREFIXES = (3, 4, 6)
PRIOR = 6.0          # pseudo-documents that each prior is worth
DRIFT = 0.7          # subtracted from every token's log-odds
FIT_ABOVE = 1.0      # the tail law is fitted on segments above
TRAIN_DOCS = 16_384  # labelled documents that the counts are fitted on, at most
CALIBRATE_DOCS = 8_192  # and the calibration
WORD_CACHE = 400_000  # words whose counts or score a task remembers at once
THRESHOLD = 0.7
WORD = re.compile(r"\w+")
SEGMENTS = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("segments", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("score", T.DoubleType())])))])


def _key(entry: str) -> int:
    return int.from_bytes(hashlib.blake2b(entry.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _keys(word: str) -> tuple[int, ...]:
    """Keys of the word's prefixes (a blank, which no word holds, tells them
    from words), then of the word itself."""
    return (*(_key(f"{k} {word[:k]}") for k in PREFIXES), _key(word))


def token_counts(labelled: DataFrame) -> DataFrame:
    """(text, toxic) -> (entry, toxic_docs, clean_docs); the null entry counts
    the distinct words themselves. Counted in each task before the shuffle."""

    def count(batches):
        sides = Counter(), Counter()

        def counted():
            entries: dict[int | None, list[int]] = {None: [0, 0]}
            for side, words in enumerate(sides):
                for w, n in words.items():
                    for key in (*_keys(w), None):
                        entries.setdefault(key, [0, 0])[side] += n
                words.clear()
            keys = list(entries)
            for at in range(0, len(keys), 50_000):
                part = keys[at:at + 50_000]
                yield pa.record_batch([pa.array(part, pa.int64()), pa.array([entries[k][1] for k in part], pa.int64()),
                                       pa.array([entries[k][0] for k in part], pa.int64())],
                                      names=["entry", "toxic_docs", "clean_docs"])

        for batch in slices(batches):
            for text, toxic in zip(batch.column(0), batch.column(1)):
                sides[1 if toxic.as_py() else 0].update(set(WORD.findall((text.as_py() or "").lower())))
            if len(sides[0]) + len(sides[1]) > WORD_CACHE // 2:
                yield from counted()
        yield from counted()

    return (labelled.select("text", "toxic").mapInArrow(count, "entry long, toxic_docs long, clean_docs long")
            .groupBy("entry").agg(F.sum("toxic_docs").alias("toxic_docs"), F.sum("clean_docs").alias("clean_docs")))


class TokenOdds:
    """Scores of words under the counted model: sorted keys, toxic and clean
    documents of each."""

    def __init__(self, keys: np.ndarray, toxic: np.ndarray, clean: np.ndarray, words: tuple[float, float]):
        self.keys, self.toxic, self.clean, self.words = keys, toxic, clean, words
        self.base = (words[0] + 0.5) / (sum(words) + 1.0)
        self.trained = min(words) > 0

    @classmethod
    def counted(cls, counts: DataFrame) -> "TokenOdds":
        # One narrow row per word and prefix.
        total = counts.filter("entry is null").first()
        rows = counts.filter("entry is not null").select(
            "entry", F.col("toxic_docs").cast("float"), F.col("clean_docs").cast("float")).toArrow()
        keys, toxic, clean = (rows.column(i).to_numpy() for i in range(3))
        order = np.argsort(keys)
        words = (float(total.toxic_docs), float(total.clean_docs)) if total else (0.0, 0.0)
        return cls(keys[order], toxic[order], clean[order], words)

    def scores(self, words: list[str]) -> np.ndarray:
        if not self.trained or not words:
            return np.full(len(words), -DRIFT)
        share = np.full(len(words), self.base)
        for keys in np.array([_keys(w) for w in words], np.int64).T:
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[at] == keys
            t, c = (np.where(known, side[at], 0.0).astype(np.float64) for side in (self.toxic, self.clean))
            share = (t + PRIOR * share) / (t + c + PRIOR)
        share = np.clip(share, 1e-9, 1 - 1e-9)
        return np.log(share / (1 - share)) - math.log(self.base / (1 - self.base)) - DRIFT


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of ``scores``, by one
    scan that keeps disjoint candidates with the sums before and after each."""
    n = len(scores)
    if not n:
        return []
    positive = scores > 0
    if not positive.any():
        return []
    edges = np.flatnonzero(np.diff(positive)) + 1
    starts = np.concatenate(([0], edges))
    sums = np.add.reduceat(scores, starts)
    ends = np.concatenate((edges, [n]))
    found: list[list[float]] = []  # start, end, sum before, sum after
    total = 0.0
    for start, end, s, up in zip(starts.tolist(), ends.tolist(), sums.tolist(), positive[starts].tolist()):
        if not up:
            total += s
            continue
        new = [start, end, total, total + s]
        total += s
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                # A candidate that begins no lower can never be joined to this
                # one or to a later one: its search goes on to its left.
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                found.append([*new, j])
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
    return [(int(a), int(b), after - before) for a, b, before, after, _ in found]


def damped(words: list[str], scores: np.ndarray, segment: tuple[int, int, float]) -> float:
    """The score of ``segment`` less its repeats."""
    start, end, score = segment
    times: dict[str, int] = {}
    full = once = 0.0
    for i in (start + np.flatnonzero(scores[start:end] > 0)).tolist():
        times[words[i]] = k = times.get(words[i], 0) + 1
        full += scores[i]
        once += scores[i] / k
    return score * once / full


def segments(docs: DataFrame, odds: TokenOdds, keep: list[Column | str],
             law: tuple[float, float] | None = None) -> DataFrame:
    """``keep`` columns, ``n_tokens`` and ``segments`` (start and end token,
    score) of each row's whole ``text``: all of them, or under a ``law`` (lambda,
    ln K) every significant one."""
    model = docs.sparkSession.sparkContext.broadcast((odds.keys, odds.toxic, odds.clean, odds.words))
    kept = docs.select(*keep, F.col("text").alias("__text"))

    def scan(batches):
        m = TokenOdds(*model.value)
        known: dict[str, float] = {}
        for batch in slices(batches):
            counts, spans = [], []
            for text in batch.column(batch.num_columns - 1):
                words = WORD.findall((text.as_py() or "").lower())
                if len(known) > WORD_CACHE:
                    known.clear()
                new = list(set(words).difference(known))
                known.update(zip(new, m.scores(new).tolist()))
                scores = np.fromiter(map(known.__getitem__, words), np.float64, len(words))
                counts.append(len(words))
                least = 0.0 if law is None else max(0.0, law[1] + math.log(max(1, len(words)))) / law[0]
                # Damping lowers a score, so what is below before it is below after it.
                found = [(a, b, damped(words, scores, (a, b, s))) for a, b, s in maximal_segments(scores) if s > least]
                spans.append([{"start": a, "end": b, "score": s} for a, b, s in found if s > least])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(spans, kind)],
                names=[*batch.schema.names[:-1], "n_tokens", "segments"])

    schema = T.StructType(kept.drop("__text").schema.fields + SEGMENTS.fields)
    return kept.mapInArrow(scan, schema)


def fit_extremes(clean: DataFrame) -> tuple[float, float]:
    """(lambda, ln K) from clean documents: segments above x come at a rate of
    K n e^(-lambda x), so the excesses over ``FIT_ABOVE`` are exponential."""
    tail = F.filter("segments", lambda s: s["score"] >= FIT_ABOVE)
    each = F.transform(tail, lambda s: s["score"] - FIT_ABOVE)
    found = clean.agg(F.sum("n_tokens").alias("tokens"), F.sum(F.size(tail)).alias("found"),
                      F.sum(F.aggregate(each, F.lit(0.0), lambda acc, x: acc + x)).alias("excess")).first()
    if not found.tokens:
        return 1.0, 0.0
    lam = min(max((found.found + 1) / ((found.excess or 0.0) + 1.0), 0.05), 5.0)
    return lam, math.log((found.found + 1) / found.tokens) + lam * FIT_ABOVE


def _level(log_k: float) -> Column:
    """ln(K n) of a text of n tokens, at least 0: in a text shorter than 1 / K
    no segment is expected, which alone is evidence of nothing."""
    return F.greatest(F.log(F.greatest("n_tokens", F.lit(1))) + F.lit(log_k), F.lit(0.0))


def evidence(lam: float, log_k: float) -> Column:
    """What the significant segments exceed the level by, summed."""
    return F.aggregate("segments", F.lit(0.0),
                       lambda acc, s: acc + F.greatest(F.lit(0.0), s["score"] * lam - _level(log_k)))


def fit_logistic(labelled: DataFrame) -> tuple[float, float]:
    """(slope, offset) of P(toxic) on ln(1 + evidence), by Newton steps with
    halving on a histogram of a few hundred values."""
    bins = (labelled.groupBy(F.round(F.log1p("evidence"), 2).alias("z"))
                    .agg(F.sum("toxic").alias("toxic"), F.count("*").alias("docs")).collect())
    start = np.array([2.0, -4.0])
    if not bins or not sum(b.toxic for b in bins):
        return float(start[0]), float(start[1])
    x = np.stack([np.array([b.z for b in bins]), np.ones(len(bins))], 1)
    hit, docs = (np.array([b[c] for b in bins], float) for c in ("toxic", "docs"))
    ridge = 0.05

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((docs * np.logaddexp(0, z) - hit * z).sum() + ridge / 2 * ((w - start) ** 2).sum())

    w = start
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w)))
        gradient = x.T @ (hit - docs * p) - ridge * (w - start)
        curve = (x * (docs * p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        while np.abs(step).max() > 1e-9 and loss(w + step) > loss(w):
            step = step / 2
        w = w + step
    return float(max(w[0], 0.05)), float(w[1])


class Judge:
    """The fitted model: token odds, tail law and logistic curve."""

    def __init__(self, odds: TokenOdds, law: tuple[float, float], curve: tuple[float, float]):
        self.odds, self.law, self.curve = odds, law, curve

    def scored(self, docs: DataFrame, keep: list[Column | str]) -> DataFrame:
        """``keep`` columns, n_tokens, passages (the significant segments),
        evidence and score of every row of ``docs``."""
        out = segments(docs, self.odds, keep, self.law).withColumn("evidence", evidence(*self.law))
        slope, offset = self.curve
        score = 1 / (1 + F.exp(-(F.log1p("evidence") * slope + offset))) if self.odds.trained else F.lit(0.0)
        return out.withColumnRenamed("segments", "passages").withColumn("score", score)


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> Judge:
    """The model from the labelled rows of ``docs`` whose doc_id meets ``learn``.
    The labelled ids that are used are at most ``TRAIN_DOCS`` and ``CALIBRATE_DOCS``,
    so they are broadcast and no text is shuffled."""
    marks = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
                   .filter(F.lit(True) if learn is None else learn)
                   .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    calibrates = (F.xxhash64("doc_id") % 4) == 0

    def texts(which: Column, most: int) -> DataFrame:
        some = marks.filter(which).orderBy(F.xxhash64("doc_id", F.lit(0)), "doc_id").limit(most)
        return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "toxic")

    odds = TokenOdds.counted(stored(token_counts(texts(~calibrates, TRAIN_DOCS)), "token-counts"))
    held = stored(segments(texts(calibrates, CALIBRATE_DOCS), odds, ["toxic"]), "calibration")
    law = fit_extremes(held.filter("toxic = 0"))
    return Judge(odds, law, fit_logistic(held.withColumn("evidence", evidence(*law))))


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> DataFrame:
    """(rid, doc_id, n_tokens, passages, evidence, score) for every row of
    ``docs`` (doc_id, text): ``rid`` numbers the rows as read, ``passages`` are the
    significant segments.

    ``learn`` limits the labelled documents (a condition on doc_id) that the
    model is fitted on.
    """
    return fit(docs, labels, learn).scored(docs, [F.monotonically_increasing_id().alias("rid"), "doc_id"])


def toxic_passages(scored: DataFrame) -> DataFrame:
    """(rid, doc_id, start, end, score): every significant passage, in tokens."""
    return scored.select("rid", "doc_id", F.inline("passages"))


def learnable() -> Column:
    """Documents whose labels may be learned from in the registered query."""
    return id_bucket("doc_id", 3) != 1


def q_toxicity(spark, sf_dir):
    from pricetide.llm.common import read

    scored = score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), learnable())
    return scored.select("doc_id", F.coalesce(id_bucket("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows scored toxic; all columns as they were. Every
    row goes by its own text's score, whatever its doc_id: null, or one that
    other rows share."""
    found = fit(docs, labels, learnable()).scored(docs, [F.struct(*docs.columns).alias("row")])
    return found.filter(F.col("score") < THRESHOLD).select("row.*")
