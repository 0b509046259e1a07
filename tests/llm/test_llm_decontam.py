"""Decontamination against a brute-force search."""

import re

import pytest

from pricetide.llm import decontam as D

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORDS.findall(lowered)


def brute(text, bench):
    words, hit, items = split(text), set(), set()
    for item, t in bench:
        if item is None:
            continue
        iw = split(t)
        n = min(10, len(iw))
        for s in range(len(iw) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i:i + n] == iw[s:s + n]:
                    hit.update(range(i, i + n))
                    items.add(str(item))
    return len(words), len(hit), sorted(items)


def phrase(seed, n, size):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i * seed) % size}" for i in range(n))


BENCH = [(1, phrase(1, 25, 40)), (2, phrase(2, 12, 9)), (3, "Short Item, here!"), (30, "a a a a a a a a a a a a"),
         (4, None), (5, ""), (None, phrase(9, 20, 30)), (7, "die Straße Été 42"), (1, phrase(11, 15, 50)), (12, "the")]
DOCS = [(1, "x y " + phrase(1, 25, 40) + " z"), (2, phrase(2, 11, 9) + " " + phrase(2, 12, 9)),
        (3, "a SHORT-item; here it is"), (4, "a " * 30), (5, None), (6, ""), (7, "...!"),
        (8, phrase(1, 14, 40) + " gap " + phrase(1, 25, 40)), (9, "DIE straße, Été/42 die stra e"),
        (8, phrase(1, 14, 40)), (None, phrase(11, 15, 50)), (10, "The other " + "long " * 30_000 + "the"),
        *((100 + i, phrase(i % 5, 60, 12)) for i in range(40))]


@pytest.fixture(scope="module")
def frames(spark):
    return (spark.createDataFrame(DOCS, "doc_id long, text string"),
            spark.createDataFrame(BENCH, "item_id long, text string"))


@pytest.mark.parametrize("block_bytes", [1 << 24, 250])
def test_equals_brute_force(frames, monkeypatch, block_bytes):
    docs, bench = frames
    blocks = D.benchmark_blocks
    monkeypatch.setattr(D, "benchmark_blocks", lambda b: blocks(b, block_bytes))
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.items, r.contaminated) for r in
                  D.contamination(docs, bench).collect()), key=str)
    want = sorted(((i, n, h, items, h > 0) for i, t in DOCS for n, h, items in [brute(t, BENCH)]), key=str)
    assert got == want


def test_drop_keeps_rows_without_id_and_extra_columns(spark, frames):
    docs, bench = frames
    kept = D.drop_contaminated(docs.selectExpr("*", "'z' as rid", "1 as at"), bench)
    assert kept.columns == ["doc_id", "text", "rid", "at"]
    # Every row goes by its own text, the one without an id too.
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        ((i, t) for i, t in DOCS if not brute(t, BENCH)[1]), key=str)


def test_empty_tables(spark, frames):
    docs, bench = frames
    assert D.contamination(docs.limit(0), bench).count() == 0
    assert D.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_proximity_takes_small_shifts(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "alpha xx beta gamma delta"),
                                  (3, "alpha xx yy zz beta gamma delta"), (4, "beta alpha gamma delta")],
                                 "doc_id long, text string")
    assert {r.doc_id for r in D.proximity_matches(docs, bench, 0).collect()} == {1}
    assert {r.doc_id for r in D.proximity_matches(docs, bench, 1).collect()} == {1, 2}


def test_proximity_in_a_text_of_one_word(spark):
    import time

    item, text = " ".join(["a"] * 10), "a " * 3_000
    bench = spark.createDataFrame([(1, item), (2, "a b c d e f g h i j")], "item_id long, text string")
    docs = spark.createDataFrame([(1, text), (2, "x " * 3_000 + "a b c d e f g h i j")], "doc_id long, text string")
    D.proximity_matches(docs.limit(0), bench, 1).count()
    start = time.time()
    got = D.proximity_matches(docs, bench, 1).groupBy("doc_id", "item_id").count().collect()
    assert {(r.doc_id, r.item_id): r["count"] for r in got} == {(1, "1"): 3_000 - 9 + 1, (2, "2"): 1}
    assert time.time() - start < 20
