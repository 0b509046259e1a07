"""SimHash against brute force, dense groups, edge cases."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pricetide.llm import simhash as S
from pricetide.llm.components import connected_components


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    runs = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits=4):
    parent = {int(f): int(f) for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    a = np.array(sorted(parent), np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1:]) <= max_bits) + i + 1:
            x, y = find(int(a[i])), find(int(a[j]))
            parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in parent}


TEXTS = [None, "", " \t\n", "One", "a b c", "A b C", "Ünïcode Été WORD four five", "x " * 500, "w" * 20_000,
         " ".join(f"t{i % 97}" for i in range(70_000)), "nbsp stays in\x1fone word here"]


def test_fingerprints_equal_brute_force():
    for text in TEXTS:
        got = S.fingerprint((text or "").encode(), 4)
        assert got & (2**64 - 1) == brute_fingerprint(text)


@pytest.mark.parametrize("chunk,small", [(32_768, 4_096), (8, 4)])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, chunk, small):
    """Random values, and dense groups of thousands of flips around a few
    centres; the small limits force hot keys, open groups and blocks."""
    monkeypatch.setattr(S, "CHUNK", chunk)
    monkeypatch.setattr(S, "SMALL_PAIRS", small)
    state = np.arange(1, 5000, dtype=np.uint64)
    mixed = state * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    values = set(mixed[:1500].tolist())
    for n, flips in enumerate(mixed[1500:2300].tolist()):
        centre = int(mixed[n % 3])
        for k in range(1 + n % 5):
            centre ^= 1 << (flips >> (6 * k) & 63)
        values.add(centre)
    expected = brute_components(values)
    fps = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    links = S.fingerprint_links(fps)
    rows = links.collect()
    assert len(rows) < 40 * len(values)
    for r in rows:
        assert bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 4
    got = {r.node & (2**64 - 1): r.component & (2**64 - 1) for r in connected_components(links).collect()}
    groups, wanted = {}, {}
    for v in values:
        groups.setdefault(got.get(v, v), set()).add(v)
        wanted.setdefault(expected[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_every_plan_finds_every_pair():
    """The thresholds cover: any pattern of four flips is caught by a probed
    partition."""
    rng = np.arange(3000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for n in (10, 10_000, 10**9):
        plan = S.plan_partitions(rng.view(np.int64), n, 4)
        assert sum(t + 1 for _, t in plan) == 5
        assert len({b for bits, _ in plan for b in bits}) == sum(len(bits) for bits, _ in plan)


def test_documents_with_null_ids_copies_and_blank_texts(spark):
    rows = [(5, "same words in this text"), (3, "Same WORDS in this text"), (None, "same words in this text"),
            (7, None), (8, ""), (9, "quite another text of six words"), (9, "quite another text of six words"),
            (None, "only a text without any id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    found = S.near_duplicates(docs)
    got = sorted(((r.doc_id, r.component_id) for r in found.collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (None, 3), (7, 7), (8, 7), (9, 9), (9, 9), (None, None)], key=str)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 7, 9, None], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(docs).count() == 0
    assert S.keep_one(docs).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201),
                                                                                   (201, 200)]
    got = {r.node: r.component for r in
           connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert got == expected
