"""Token shards: Elias-Fano sequences, exact round trip, order, edge cases."""

import math
import zlib

import numpy as np
import pyarrow.parquet as pq
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pricetide.llm import tokenids as K
from pricetide.session import scratch_path

SF_SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def brute(rows):
    """(doc_id, start, n, crc) of (doc_id, text) rows in doc_id order."""
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=900))
def test_sequence_gives_every_value_back(values):
    values = sorted(values)
    ef = K.EliasFano.from_bytes(K.EliasFano.of(np.array(values, np.int64)).to_bytes())
    assert ef.all().tolist() == values
    assert [ef.select(i) for i in range(len(values))] == values
    for v in values[:20]:
        assert ef.first_not_below(v) == values.index(v)
        assert ef.first_not_below(v + 1) == sum(x <= v for x in values)


def test_sequence_is_near_its_bound():
    values = np.cumsum(np.random.default_rng(1).integers(1, 4000, 100_000))
    size = 8 * len(K.EliasFano.of(values).to_bytes())
    assert size <= len(values) * (2 + math.ceil(math.log2(values[-1] / len(values))) + 32 / K.STEP) + 400
    gaps = np.array([0, 0, 5, 1 << 33, 1 << 33])
    assert K.EliasFano.of(gaps).all().tolist() == gaps.tolist()


@pytest.mark.parametrize("chars,cache", [(50, 40), (1 << 20, 8 << 20)])
def test_parts_have_the_ids_of_the_whole(monkeypatch, chars, cache):
    monkeypatch.setattr(K, "ENCODE_CHARS", chars)
    monkeypatch.setattr(K, "CACHE_CHARS", cache)
    texts = ["word and  word\n\n más 12 ab cd's 's \t x\u00a0 y \x1c z" * 40, "", " ", "x" * 500, "a b " * 200,
             "  two  spaces " * 30, "a <|endoftext|> b<|endoftext|> c", "語 の 、 。 é\u0301 \u2003 ab"]
    encode = K.Encoder(TOKENIZER, "H", True)
    for _ in range(2):
        got = [np.frombuffer(x, "<u2").tolist() for x in encode(texts)]
        assert got == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("a b'sé1,\n\t\u00a0\u3000\x1c\x85語<|endoftext|>"), max_size=60))
def test_any_text_in_parts(text):
    got = np.frombuffer(K.Encoder(TOKENIZER, "H", True)([text])[0], "<u2").tolist()
    assert got == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_texts_with_and_without_lone_spaces_share_an_encoder():
    texts = ["a word\n", "a word\n more", "a  word", "a word more", " a word", "word \n a", "a word ", "", " ", "word\u3000 a"]
    got = K.Encoder(TOKENIZER, "H", True)(texts * 2)
    want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts * 2]
    assert [np.frombuffer(ids, "<u2").tolist() for ids in got] == want


def test_lone_spaces_need_no_pattern(monkeypatch):
    class Never:
        split = staticmethod(lambda text: pytest.fail(f"split by pattern: {text!r}"))

    text = "Every space here is\na lone one, so far."
    monkeypatch.setattr(K, "PARTS", Never)
    got = K.Encoder(TOKENIZER, "H", True)([text])[0]
    assert np.frombuffer(got, "<u2").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_words_have_the_ids_of_the_whole():
    rows = [r for name in ("sf0.001", "sf0.01") for r in
            pq.read_table(f"/root/testdata/{name}/documents.parquet").column("text").to_pylist() if r]
    rows += [" ".join(chr(c) * n for c in range(0xC0, 0x100) for n in (1, 2, 7)), "A à, É. ß! ÿ? Ø: ×; ÷ aÀb",
             "one.\nTwo three\nfour, five!\nsix\n\nseven eight\n nine ten \neleven x\né,"]
    got = K.Encoder(TOKENIZER, "H", True)(rows)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [
        e.ids for e in TOKENIZER.encode_batch(rows, add_special_tokens=False)]


def test_which_tokenizers_split_at_spaces():
    read = lambda name: open(public_tokenizers.path(name), encoding="utf-8").read()
    assert K.splits_at_spaces(read("byte_bpe_50k.json"))
    assert not K.splits_at_spaces(read("word_bpe_49k.json"))


def test_whole_texts_with_another_tokenizer(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    folder = scratch_path(spark, "ids")
    docs = spark.createDataFrame([(1, "Some words here"), (2, None)], "doc_id int, text string")
    got = {r.doc_id: list(r.ids) for r in K.lookup(K.write_shards(docs, folder, path), folder, [1, 2]).collect()}
    assert got == {1: [*Tokenizer.from_file(path).encode("Some words here", add_special_tokens=False).ids, 0], 2: [0]}


ROWS = [(5, "five"), (-3, "minus"), (None, "no id"), (None, None), (2**53 + 1, "big"), (7, ""), (7, None),
        (8, "same row"), (8, "same row"), (1, "wörter und 語 " * 3000), (9, "<|endoftext|>")]


@pytest.mark.parametrize("shard_ids,shard_docs", [(1 << 20, 1 << 20), (20, 1 << 20), (1 << 20, 2)])
def test_round_trip(spark, shard_ids, shard_docs):
    docs = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "doc_id long, text string, start string, shard int")
    folder = scratch_path(spark, "ids")
    manifest = K.write_shards(docs, folder, PATH, shard_ids=shard_ids, shard_docs=shard_docs)
    got = sorted(map(tuple, K.read_shards(manifest, folder).collect()), key=lambda r: r[1])
    want = brute(ROWS)
    # rows of one doc_id come in a fixed but unnamed order
    assert [r[0] for r in got] == [r[0] for r in want]
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == sorted((str(r[0]), r[2], r[3]) for r in want)
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]
    found = {(r.doc_id, tuple(r.ids)) for r in K.lookup(manifest, folder, [5, 7, 8, 2**53 + 1, 2**53, 99]).collect()}
    end = lambda t: (*TOKENIZER.encode(t, add_special_tokens=False).ids, 0)
    assert found == {(5, end("five")), (7, (0,)), (8, end("same row")), (2**53 + 1, end("big"))}


def test_special_strings_as_text(spark):
    docs = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id int, text string")
    folder = scratch_path(spark, "ids")
    ids = K.lookup(K.write_shards(docs, folder, PATH, specials_as_text=True), folder, [1]).first().ids
    assert 50256 not in ids and TOKENIZER.decode(ids[:-1]) == "a<|endoftext|>b"


def test_empty_table_and_wrong_key(spark):
    folder = scratch_path(spark, "ids")
    manifest = K.write_shards(spark.createDataFrame([], "doc_id long, text string"), folder, PATH)
    assert K.read_shards(manifest, folder).count() == 0
    assert K.lookup(manifest, folder, [1]).count() == 0
    with pytest.raises(TypeError):
        K.write_shards(spark.createDataFrame([("a", "b")], "doc_id string, text string"), folder, PATH)


def test_query_against_the_tokenizer(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted(map(tuple, K.q_token_ids(spark, SF_SMALL).collect()))
    assert got == sorted(brute(rows))
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
