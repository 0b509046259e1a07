"""Segments against their definition, calibration and held-out accuracy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricetide.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def by_definition(scores):
    """Maximal segments: the best one, then those to its left and right."""
    if not len(scores):
        return []
    best, span = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-12 or (span and abs(total - best) <= 1e-12 and j - i < span[1] - span[0] - 1):
                best, span = total, (i, j + 1)
    if span is None:
        return []
    a, b = span
    return by_definition(scores[:a]) + [(a, b, best)] + [(s + b, e + b, v) for s, e, v in by_definition(scores[b:])]


def test_maximal_segments_follow_their_definition():
    for seed in range(60):
        scores = np.array([((seed * 131 + i * 977 + i * i * 13) % 23) / 4 - 3.1 + (seed % 7) / 9
                           for i in range(seed % 40)])
        got = T.maximal_segments(scores)
        want = by_definition(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_nothing_labelled_scores_zero(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in T.score_toxicity(docs, labels).collect()} == {0.0}
    assert T.score_toxicity(docs.limit(0), labels).count() == 0


def test_odd_rows_are_scored(spark):
    docs = [(i, "you are scum and vile " * 3 if i % 2 else "a kind and calm text of some words " * 3)
            for i in range(200)]
    docs += [(None, "you scum"), (7, "you are scum and vile"), (900, None), (901, ""), (902, "x" * 50_000),
             (903, "scum " * 20_000)]
    labels = [(i, 1, i % 2) for i in range(200)] + [(4, 1, 0), (None, 1, 1), (5, 1, None), (5000, 1, 1)]
    found = T.score_toxicity(
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("clash")),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = [(r.doc_id, r.score) for r in found.collect()]
    assert len(got) == len(docs) and all(0 <= s <= 1 for _, s in got)
    score = dict(got)
    passages = T.toxic_passages(found).filter("doc_id = 7").collect()
    assert passages and all(0 <= p.start < p.end and p.score > 0 for p in passages)
    assert min(s for i, s in got if i is not None and i < 200 and i % 2) > 0.7
    assert max(s for i, s in got if i is not None and i < 200 and not i % 2) < 0.7
    assert score[900] == score[901] < 0.7 and score[903] > 0.7


@pytest.fixture(scope="module")
def scored(spark):
    return T.q_toxicity(spark, SF).cache()


def test_held_out_accuracy(spark, scored):
    truth = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.filter("held_out").join(truth, "doc_id").select("toxic", "predicted").collect()
    hit = sum(r.toxic and r.predicted for r in rows)
    assert hit / sum(r.toxic for r in rows) >= 0.88
    assert hit / sum(r.predicted for r in rows) >= 0.95


def test_every_document_is_scored_once(spark, scored):
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert scored.filter("score is null or score < 0 or score > 1").count() == 0


def test_every_word_has_counts_of_its_own(spark):
    # A million rare clean words would fill any fixed table of half a million slots.
    clean = [(" ".join(f"{j * 7919 % 900_007:x}q{i:x}z{j:x}" for j in range(5000)), 0) for i in range(60)]
    toxic = [(f"vile{i} words", 1) for i in range(40)]
    frame = spark.createDataFrame(clean + toxic + [(None, 1), ("", 0)], "text string, toxic int").repartition(4)
    odds = T.TokenOdds.counted(T.token_counts(frame))
    assert odds.words == (80.0, 300_000.0)
    at = dict(zip(odds.keys.tolist(), zip(odds.toxic.tolist(), odds.clean.tolist())))
    words = {w for text, _ in clean + toxic for w in text.split()}
    assert all(at[T._key(w)] == ((40, 0) if w == "words" else (1, 0) if w.startswith("vile") else (0, 1)) for w in words)
    assert at[T._key("4 vile")] == (40, 0) and T._key("vile") not in at


def test_a_passage_counts_the_same_after_an_earlier_one(spark):
    train = [(i, "you are scum and vile " * 3 if i % 2 else "a kind and calm text of some words " * 3) for i in range(200)]
    passage, calm = "you are scum and vile", "a kind and calm text of some words " * 40
    docs = train + [(500, calm + passage), (501, (calm + passage + " ") * 6), (502, passage * 1)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    found = T.score_toxicity(spark.createDataFrame(docs, "doc_id long, text string"), labels)
    got = {r.doc_id: r.passages for r in found.filter("doc_id >= 500").collect()}
    assert [len(got[i]) for i in (500, 501, 502)] == [1, 6, 1]
    assert np.allclose([s.score for s in got[501]], got[500][0].score)
    words = ["x", "y", "x"]
    assert T.damped(words, np.array([2.0, -1.0, 2.0]), (0, 3, 3.0)) == pytest.approx(3.0 * 3 / 4)


def frame_of(spark, rows):
    kind = "array<struct<start:int,end:int,score:double>>"
    return spark.createDataFrame([(n, [(0, 1, float(x)) for x in scores], t) for n, scores, t in rows],
                                 f"n_tokens long, segments {kind}, toxic int")


def test_the_tail_law_is_found_again(spark):
    r = np.random.default_rng(2)
    lam, k = 1.7, 0.05
    rows = []
    for _ in range(400):
        n = int(r.integers(50, 400))
        rows.append((n, r.exponential(1 / lam, r.poisson(k * n)).tolist(), 0))
    got = T.fit_extremes(frame_of(spark, rows))
    assert got[0] == pytest.approx(lam, rel=0.1) and got[1] == pytest.approx(np.log(k), abs=0.25)
    # Evidence by its definition, also of scores below the fit's threshold.
    for n, scores, e in frame_of(spark, rows[:50]).select("n_tokens", "segments", T.evidence(*got)).collect():
        level = max(0.0, np.log(n) + got[1])
        assert e == pytest.approx(sum(max(0.0, got[0] * s.score - level) for s in scores))


def test_the_logistic_curve_is_found_again(spark):
    r = np.random.default_rng(4)
    z = r.uniform(0, 4, 6000)
    toxic = r.uniform(size=6000) < 1 / (1 + np.exp(-(2.5 * z - 5)))
    frame = spark.createDataFrame([(float(np.expm1(a)), int(b)) for a, b in zip(z, toxic)], "evidence double, toxic int")
    assert T.fit_logistic(frame) == pytest.approx((2.5, -5.0), abs=0.3)


def test_a_significant_segment_below_the_fit_threshold_is_kept(spark):
    words = ["calm"] * 10 + ["vile"] + ["calm"] * 10
    keys = sorted([T._key("vile"), T._key("calm")])
    # "vile" scores a little under 1.0
    toxic = np.array([8.0 if k == T._key("vile") else 0.0 for k in keys], np.float32)
    clean = np.array([0.0 if k == T._key("vile") else 80.0 for k in keys], np.float32)
    odds = T.TokenOdds(np.array(keys), toxic, clean, (40.0, 80.0))
    score = odds.scores(["vile"])[0]
    assert 0.5 < score < T.FIT_ABOVE
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    found = T.segments(docs, odds, ["doc_id"], (2.0, -2.0)).first()
    assert np.log(21) - 2.0 < 2.0 * score
    assert [(s.start, s.end) for s in found.segments] == [(10, 11)]
    assert T.segments(docs, odds, ["doc_id"], (1.0, 0.0)).first().segments == []


def test_the_fit_takes_a_bounded_number_of_texts(spark, monkeypatch):
    monkeypatch.setattr(T, "TRAIN_DOCS", 40)
    monkeypatch.setattr(T, "CALIBRATE_DOCS", 30)
    docs = spark.createDataFrame([(i, "you are scum and vile " * 3 if i % 2 else "a kind and calm text of words")
                                  for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(400)], "doc_id long, quality int, toxic int")
    model = T.fit(docs, labels)
    assert model.odds.words[0] + model.odds.words[1] <= 40 * 7
    assert T.reject_toxic(docs, labels).count() == 400 - sum(
        r.score >= T.THRESHOLD for r in T.score_toxicity(docs, labels, T.learnable()).collect())
