"""Phrase collocations against a plain count of all phrases."""

import collections
import random
import re

import pytest

from pricetide.llm import collocations as C


def brute(rows, min_count, covered=80, top=2000):
    f = collections.Counter()
    n = collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    cand = {p: c for p, c in f.items() if len(p[1]) > 1 and c >= min_count}
    out = []
    for (lang, words), a in cand.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        inside = [c for (other, longer), c in cand.items() if other == lang and len(longer) > len(words)
                  and any(longer[i:i + len(words)] == words for i in range(len(longer)))]
        if not any(100 * c >= covered * a for c in inside):
            score, _, left, right = min(cuts)
            out.append((lang, " ".join(words), a, left, right, n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(x[0], i + 1, *x[1:]) for i, x in enumerate(own)]
    return sorted(ranked)


def rows():
    r = random.Random(3)
    vocabulary = ["the", "The", "of", "a", "b", "new", "york", "x\x01", "b\x01y", "ÄÖ", "é|", "und", "rare%d"]
    out = []
    for i in range(160):
        words = [w % r.randrange(900) if "%d" in w else w for w in r.choices(vocabulary, k=r.randrange(0, 60))]
        text = "".join(w + r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", " ; "]) for w in words)
        out.append((r.choice(["en", "en", "de", None, "und"]), text))
    out += [("en", "one two three four five. " * 40), ("en", "one two three four five. " * 40), ("fr", None),
            ("fr", ""), ("fr", "seul"), (None, "the of " * 300), ("en", "z z z z z z z z z z")]
    return out


@pytest.mark.parametrize("min_count,group_suffixes,distinct", [(2, 1, 1 << 19), (3, 50, 10), (5, 1 << 22, 1 << 19)])
def test_against_all_phrases(spark, monkeypatch, min_count, group_suffixes, distinct):
    monkeypatch.setattr(C, "DISTINCT", distinct)
    data = rows()
    docs = spark.createDataFrame([(*r, 1, "clash") for r in data], "lang string, text string, f int, group string")
    got = C.collocations(docs.repartition(3), min_count, top=25, group_suffixes=group_suffixes).drop("words", "cut")
    assert sorted(map(tuple, got.collect())) == brute(data, min_count, top=25)


def test_full_bitmap_costs_rows_only(spark, monkeypatch):
    monkeypatch.setattr(C, "BITMAP_BITS", 1 << 15)
    monkeypatch.setattr(C, "_bitmap", lambda words, bits: b"\xff" * (bits // 8))
    data = rows()[:60]
    docs = spark.createDataFrame(data, "lang string, text string")
    assert sorted(map(tuple, C.collocations(docs, 4).drop("words", "cut").collect())) == brute(data, 4)


def test_score_is_exact_beyond_64_bits(spark):
    a, l, r = 4 * 10**12 + 1, 7 * 10**12, 4 * 10**12 + 3
    got = spark.sql(f"SELECT CAST(CAST({C.SCALE} AS DECIMAL(8,0)) * CAST({a} AS DECIMAL(19,0)) div (CAST({l} AS "
                    f"DECIMAL(19,0)) + CAST({r} AS DECIMAL(19,0))) AS BIGINT) AS s").first().s
    assert got == C.SCALE * a // (l + r) and C.SCALE * a > 2**62


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_one_very_long_text(spark):
    data = [("en", "alpha beta gamma delta " * 50_000)]
    docs = spark.createDataFrame(data, "lang string, text string")
    assert sorted(map(tuple, C.collocations(docs).drop("words", "cut").collect())) == brute(data, 30)


@pytest.mark.parametrize("size", [1, 400])
def test_subtrees_of_prefixes_longer_than_a_read(spark, monkeypatch, size):
    monkeypatch.setattr(C, "SUBTREE_BYTES", size)
    monkeypatch.setattr(C, "PIECE", 2)
    data = rows()
    docs = spark.createDataFrame(data, "lang string, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted(map(tuple, C.collocations(docs, 3, group_suffixes=300).drop("words", "cut").collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == brute(data, 3)


def test_suffixes_are_sorted_by_one_number(spark):
    docs = spark.createDataFrame(rows()[:20], "lang string, text string")
    shared = spark.sparkContext.broadcast((b"\xff" * 4096, 1 << 15, frozenset()))
    plan = C._subtrees(C._suffixes(docs, shared, 4), shared, 2)._jdf.queryExecution().optimizedPlan().toString()
    keys = [line.split("[", 1)[1].split("]")[0] for line in plan.splitlines() if "Sort [" in line]
    assert len(keys) == 1 and keys[0].startswith("prefix#") and "," not in keys[0]


def test_language_and_words_are_told_apart(spark):
    data = [("a\nb", "x y z. " * 4), ("a", "b\x01 x y z. " * 4), ("a\nb c ", "x y. " * 4), ("a", "b c x y. " * 4),
            ("a\\nb", "x y z. " * 4), ("ä\U0001f600", "x y z. " * 4), (" ", "x y z. " * 4)]
    docs = spark.createDataFrame(data, "lang string, text string")
    assert sorted(map(tuple, C.collocations(docs, 3).drop("words", "cut").collect())) == brute(data, 3)
