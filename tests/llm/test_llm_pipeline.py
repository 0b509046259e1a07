"""The pipeline's stages against their operators, and odd documents."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from pricetide.llm import decontam, simhash, toxicity
from pricetide.llm.common import stored

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(stored(stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return out


def ids(df):
    return {r.doc_id for r in df.collect()}


def test_stages_do_what_their_operators_say(spark, steps):
    docs, calm, single, clean, masked, mixed = steps
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    bad = toxicity.score_toxicity(docs, labels, toxicity.learnable()).filter(F.col("score") >= toxicity.THRESHOLD)
    assert ids(calm) == ids(docs) - ids(bad)
    groups = {r.component_id for r in simhash.near_duplicates(calm).collect()}
    assert ids(single) == groups
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    assert ids(clean) == ids(single) - ids(decontam.contamination(single, bench).filter("contaminated"))
    assert ids(masked) == ids(clean) == ids(mixed)
    for df in steps[:-1]:
        assert df.columns == docs.columns
    assert mixed.select("mix_position").distinct().count() == mixed.count()


def test_odd_documents_pass_every_stage(spark):
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (1, None, "en", "s", 0), (2, "", None, None, None),
            (3, "word " * 30_000, "en", "s", 1), (4, "a calm text of some words", "en", "t", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("score", F.lit(1)).withColumn("fp", F.lit("x")).withColumn("mix_slot", F.lit(2))
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), f"odd-{name}")
        assert {"score", "fp"} <= set(docs.columns)
    assert {3, 4} <= ids(docs) and docs.count() >= 3


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), f"empty-{name}")
    assert docs.count() == 0


def test_rows_go_by_their_own_text(spark):
    rows = [(i, "you are scum and vile " * 3 if i % 2 else "a kind and calm text of some words " * 3)
            for i in range(200)]
    item = "one two three four five six seven eight nine ten eleven twelve"
    rows += [(None, "you are scum and vile " * 3), (7, "a kind text"), (None, "a calm text"), (None, None),
             (None, f"see {item} there"), (900, f"see {item} there"), (900, "a clean text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200) if i != 7], "doc_id long, quality int, toxic int")
    calm = [(r.doc_id, r.text) for r in toxicity.reject_toxic(docs, labels).collect()]
    assert sorted(calm, key=str) == sorted((r for r in rows if "scum" not in (r[1] or "")), key=str)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = [(r.doc_id, r.text) for r in decontam.drop_contaminated(docs, bench).collect()]
    assert sorted(clean, key=str) == sorted((r for r in rows if item not in (r[1] or "")), key=str)
