"""Ranked search against a plain score of every document."""

import collections
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricetide.llm import ranking as R


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def brute(docs, items, k=20):
    counted = [(i, row, collections.Counter(terms(t))) for row, (i, t) in enumerate(docs) if terms(t)]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for *_, c in counted)
    df = collections.Counter(t for *_, c in counted for t in c)
    out = []
    for item, text in items:
        asked = collections.Counter(terms(text))
        found = []
        for i, row, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t, n in asked.items() if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, row, i))
        out += [(item, r + 1, x[4], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def data():
    r = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["Ünder", "naïve", "x_y", "don't", "ALL", "語"]
    weight = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(r.choices(words, weight, k=r.choice([1, 5, 40, 200])))) for i in range(700)]
    docs += [(5, docs[5][1])] * 30 + [(1000 + i, docs[3][1]) for i in range(60)]  # copies: equal scores
    docs += [(None, docs[9][1]), (None, None), (901, None), (902, ""), (903, " .,! "), (904, "w1 " * 30_000),
             (2**53, "w7 w8 w9"), (2**53 + 1, "w7 w8 w9")]
    items = [(i, " ".join(r.choices(words, weight, k=r.choice([1, 3, 30])))) for i in range(40)]
    items += [(3, "w1 W1 w1 w250"), (None, "w5 w6"), (50, None), (51, ""), (52, "unseen"), (53, docs[3][1])]
    return docs, items


@pytest.mark.parametrize("block,bucket,seeds", [(2048, 4096, 4096), (7, 64, 16)])
def test_against_every_score(spark, monkeypatch, block, bucket, seeds):
    monkeypatch.setattr(R, "BLOCK_ITEMS", block)
    monkeypatch.setattr(R, "BUCKET_DOCS", bucket)
    monkeypatch.setattr(R, "SEED_DOCS", seeds)
    docs, items = data()
    # one partition, so that rows of equal score and doc_id keep their order
    d = spark.createDataFrame([(*x, 1.0, "c") for x in docs], "doc_id long, text string, norm double, item string")
    i = spark.createDataFrame([(*x, "c") for x in items], "item_id long, text string, score string")
    got = R.search(d.coalesce(1), i)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_full_bitmap_costs_rows_only(spark, monkeypatch):
    monkeypatch.setattr(R, "_bitmap", lambda terms, bits: b"\xff" * (bits // 8))
    docs, items = data()
    docs, items = docs[:200], items[:9]
    got = R.search(spark.createDataFrame(docs, "doc_id long, text string"),
                   spark.createDataFrame(items, "item_id long, text string"), 5)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 5)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert R.search(none, asked).count() == 0
    assert R.search(some, asked.limit(0)).count() == 0
    with pytest.raises(TypeError):
        R.search(spark.createDataFrame([("a", "b")], "doc_id string, text string"), asked)


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6), st.floats(0.2, 1.0))
def test_bounds_lose_no_document(seed, share):
    r = np.random.default_rng(seed)
    coordinates = [np.sort(r.choice(40, r.integers(1, 30), replace=False)) for _ in range(60)]
    impacts = [r.integers(1, 10**6, len(c)) for c in coordinates]
    norms = [float(np.sqrt(float((x.astype(object) ** 2).sum()))) for x in impacts]
    bucket = R.Bucket(list(range(60)), list(range(60)), norms, coordinates, impacts)
    cs = r.choice(40, 12, replace=False)
    query = dict(sorted(((int(c), int(r.integers(1, 30_000))) for c in cs), key=lambda x: -x[1]))
    dense = np.zeros(40, np.int64)
    dense[list(query)] = list(query.values())
    scores = bucket.scores(dense, np.arange(60))
    assert scores.tolist() == [int((dense[c] * x).sum()) for c, x in zip(coordinates, impacts)]
    bound = max(1, int(np.quantile(scores, share)))
    rows = bucket.survivors(query, bound)
    assert set(np.flatnonzero(scores >= bound)) <= set(rows)
    if len(rows):
        assert bucket.scores(dense, rows).tolist() == scores[rows].tolist()
