"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary get a probability per language, from
their counts in the vocabulary's own segmentation of all learnable texts. A
text's words (letter runs in lower case) are scored by the forward algorithm,

    f(i) = sum over pieces p ending at i of f(i - |p|) P(p | language),

which sums over every segmentation of a word into pieces; a character that no
piece covers counts as an unknown piece. A text scores the sum of its words'
log probabilities plus the language's share of the documents; the answer is the
best language and its posterior probability.

Texts are read in whole; a task remembers the scores of at most ``WORD_CACHE``
words. The model that is broadcast has languages x pieces numbers; languages
are the values of the column learned from.

Defined results: null texts and texts without a letter are `und` with score 0,
as is every text where nothing was learned; rows with null text or language
teach nothing; ties go to the first language in order; repeated rows are judged
alike.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.llm.common import id_bucket, slices

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SMOOTHING = 0.1       # added to every piece's count
UNKNOWN = 1e-9        # probability of a character that no piece covers
WORD_CACHE = 200_000
COUNT_WORDS = 200_000  # distinct words counted before they are segmented
BASE = 0x9E3779B97F4A7C15  # of the pieces' hash
WHOLE = 32            # longer words are scored one by one, rescaled as they go
LETTERS = re.compile(r"[^\W\d_]+")  # also runs of other numbers, which letters_of leaves out
START = "▁"      # marks a word's first piece


def load_model(path: str) -> tuple[bytes, dict[str, int]]:
    """The vocabulary file and its pieces (without control and byte pieces)."""
    with open(path, "rb") as f:
        blob = f.read()
    sp = sentencepiece.SentencePieceProcessor(model_proto=blob)
    pieces = {sp.id_to_piece(i): i for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
    return blob, pieces


def letters_of(text: str | None) -> list[str]:
    """Lower-cased runs that hold a letter: other numbers (fractions, circled
    digits) alone are none."""
    return [run for run in LETTERS.findall((text or "").lower()) if run.isalpha() or any(map(str.isalpha, run))]


def piece_counts(texts: DataFrame, blob: bytes) -> DataFrame:
    """(lang, text) -> (lang, piece, n) over whole texts."""
    shared = texts.sparkSession.sparkContext.broadcast(blob)

    def count(batches):
        sp = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        size = sp.get_piece_size()
        words: dict[str, Counter] = defaultdict(Counter)
        totals: dict[str, np.ndarray] = {}

        def segment():
            for lang, counted in words.items():
                total = totals.setdefault(lang, np.zeros(size, np.int64))
                for pieces, n in zip(sp.encode(list(counted), num_threads=1), counted.values()):
                    for p in pieces:
                        total[p] += n
            words.clear()

        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words[lang].update(letters_of(text.as_py()))
            if sum(map(len, words.values())) > COUNT_WORDS:
                segment()
        segment()
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.record_batch([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(total[used])],
                                  names=["lang", "piece", "n"])

    return (texts.select("lang", "text").mapInArrow(count, "lang string, piece long, n long")
                 .groupBy("lang", "piece").agg(F.sum("n").alias("n")))


class PieceModel:
    """Piece probabilities (pieces + unknown) x languages."""

    def __init__(self, pieces: dict[str, int], probability: np.ndarray, prior: np.ndarray):
        self.pieces, self.p, self.prior = pieces, probability, prior
        self.unknown = len(probability) - 1
        self.longest = max(map(len, pieces), default=1)
        # Pieces by a 64-bit polynomial hash of their characters.
        self.power = np.array([pow(BASE, k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        names = list(pieces)
        keys = np.array([sum(ord(c) * pow(BASE, len(x) - 1 - j, 1 << 64) for j, c in enumerate(x)) % (1 << 64)
                         for x in names], np.uint64)
        order = np.argsort(keys)
        self.keys, self.rows = keys[order], np.array([pieces[x] for x in names], np.int64)[order]

    def _long(self, word: str) -> np.ndarray:
        scale = np.zeros(self.p.shape[1])
        past = [np.ones(self.p.shape[1])]  # the forward values that pieces can still reach
        for i in range(1, len(word) + 1):
            f = past[-1] * self.p[self.pieces.get(word[i - 1:i], self.unknown)]
            for k in range(2, min(i, self.longest) + 1):
                piece = self.pieces.get(word[i - k:i])
                if piece is not None:
                    f = f + past[-k] * self.p[piece]
            past = [*past[-(self.longest - 1):], f]
            scale += np.log(f)
            past = [x / f for x in past]
        return scale

    def _forward(self, words: list[str], n: int) -> np.ndarray:
        """Probabilities of words of ``n`` characters: at every end, pieces of
        each length are looked up for all words at once."""
        codes = np.array(words, dtype=f"<U{n}").view(np.uint32).reshape(len(words), n).astype(np.uint64)
        hashes = np.zeros((n + 1, len(words)), np.uint64)
        f = [np.ones((len(words), self.p.shape[1]))]
        for i in range(1, n + 1):
            hashes[i] = hashes[i - 1] * np.uint64(BASE) + codes[:, i - 1]
            total = np.zeros_like(f[0])
            for k in range(1, min(i, self.longest) + 1):
                own = hashes[i] - hashes[i - k] * self.power[k]
                at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
                known = self.keys[at] == own
                if k == 1:
                    total += f[i - 1] * self.p[np.where(known, self.rows[at], self.unknown)]
                elif known.any():
                    hit = np.flatnonzero(known)
                    total[hit] += f[i - k][hit] * self.p[self.rows[at[hit]]]
            f.append(total)
        return f[n]

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word, summed over its segmentations."""
        out = np.empty((len(words), self.p.shape[1]))
        by_length: dict[int, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            by_length[len(w) + 1].append(i)
        for n, rows in by_length.items():
            if n > WHOLE:
                for i in rows:
                    out[i] = self._long(START + words[i])
                continue
            out[rows] = np.log(self._forward([START + words[i] for i in rows], n))
        return out


def learn(texts: DataFrame, vocabulary: str = VOCABULARY):
    """(languages, pieces, probabilities, log prior) from (lang, text) rows."""
    texts = texts.filter("lang is not null and text is not null").select(F.col("lang").cast("string"), "text")
    blob, pieces = load_model(vocabulary)
    docs = {r.lang: r["count"] for r in texts.groupBy("lang").count().collect()}
    langs = sorted(docs)
    size = max(pieces.values(), default=0) + 1
    counts = np.zeros((size, len(langs)))
    column = {lang: i for i, lang in enumerate(langs)}
    table = piece_counts(texts, blob).toArrow()  # languages x pieces rows at most
    for lang, piece, n in zip(*(table.column(c).to_pylist() for c in ("lang", "piece", "n"))):
        if piece < size:
            counts[piece, column[lang]] = n
    p = (counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * size) if langs else counts
    p = np.vstack([p, np.full(len(langs), UNKNOWN)])
    prior = np.log(np.array([docs[lang] for lang in langs], float) / max(1, sum(docs.values()))) if langs else np.zeros(0)
    return langs, pieces, p, prior


def predict(docs: DataFrame, model, keep: list[str | Column]) -> DataFrame:
    """``keep`` columns of ``docs`` plus ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*keep, F.col("text").alias("__text"))

    def scan(batches):
        langs, pieces, p, prior = shared.value
        m = PieceModel(pieces, p, prior)
        row: dict[str, int] = {}
        scores = np.zeros((0, len(langs)))
        for batch in slices(batches):
            texts = [letters_of(t.as_py()) if langs else [] for t in
                     batch.column(batch.num_columns - 1)]
            if len(row) > WORD_CACHE:
                row, scores = {}, np.zeros((0, len(langs)))
            fresh = list({w for words in texts for w in words}.difference(row))
            if fresh:
                row.update(zip(fresh, range(len(row), len(row) + len(fresh))))
                scores = np.vstack([scores, m.score(fresh)])
            sizes = np.array([len(words) for words in texts])
            some = np.flatnonzero(sizes)
            flat = np.fromiter(map(row.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
            starts = (np.cumsum(sizes) - sizes)[some]
            names, sure = ["und"] * len(texts), [0.0] * len(texts)
            if len(some):
                totals = prior + np.add.reduceat(scores[flat], starts, axis=0)
                for i, total in zip(some.tolist(), totals):
                    best = int(total.argmax())
                    names[i] = langs[best]
                    sure[i] = float(1 / np.exp(total - total[best]).sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(sure, pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score"])

    schema = T.StructType([*kept.drop("__text").schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return kept.mapInArrow(scan, schema)


def q_language(spark, sf_dir):
    from pricetide.llm.common import read

    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(id_bucket("doc_id", 4) == 2, F.lit(False))
    model = learn(docs.filter(~held_out))
    return predict(docs, model, ["doc_id", held_out.alias("held_out")])
