"""Secret scans: candidates by pattern, false positives removed by a forest.

*Candidates* are parts of words (texts split at white space): the word itself
without outer punctuation; every run of ``RUN`` characters in it; every value
that follows a name and `=`, `:`, `:=` or `=>` at any place of it, up to a closing
quote or the next name; issued key formats inside longer runs; passwords of
URLs. A part counts if it has at least ``MIN_LENGTH`` ``RUN`` characters and a
digit, or if it is assigned to a name such as password or token and has at least
``MIN_ASSIGNED``. Only texts that hold such a part are split.

*Features*, all SQL expressions on the few candidates: length, shares of
character classes, of hexadecimal and of distinct characters; the shares of
the 25 transitions between classes (vowel, consonant, upper case, digit,
other); dictionary coverage (letters inside words of a public vocabulary); the
path (depth, test or example folders); the neighbouring words (an assigning
name, an example marker, hashed neighbours).

*Forest.* Trained on labelled findings, at most ``TRAIN_FINDINGS`` of each label
by hash order. Without given labels, findings are labelled by format: issued key
formats and mixed values assigned to a secret's name are secrets; addresses,
numbers and dictionary words that nothing assigns are not; the rest is left to
the forest. Where only one label occurs, the format labels decide.

Everything is DataFrame and MLlib work inside the JVM.

Defined results: null, empty or blank texts have no candidates; a null path
counts as an empty path; findings of repeated rows are reported per row; a
value found in a text is masked wherever that text holds it.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.llm.common import stored

MIN_LENGTH = 12
MIN_ASSIGNED = 8
TRAIN_FINDINGS = 20_000
TREES, DEPTH, SEED = 20, 6, 42
THRESHOLD = 0.5
NEIGHBOUR_SLOTS = 16
MASK = "[SECRET]"
DICTIONARY = "/opt/tokenizers/word_bpe_49k.json"

# Names that announce a secret, and formats of issued keys.
SECRET_NAME = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential)s?"
KEY_FORMAT = (r"^(A(KIA|SIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk[-_][A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}"
              r"|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}.*)$")
EXAMPLE = r"(?i)(example|sample|dummy|test|placeholder|fake)"
RUN = r"[A-Za-z0-9+/_.=@~-]"
# A name is tried once, from where its run of name characters begins.
NAME_CHAR = r"[A-Za-z0-9_.-]"
NAME = rf"(?<!{NAME_CHAR})[0-9_.-]*+([A-Za-z]{NAME_CHAR}*+)"
NEXT = rf"[&;,?][\"']?[A-Za-z]{NAME_CHAR}*+[\"']?[:=]"
# A name, its separator and, looked ahead so that values may nest, its value.
NAMED = (rf"{NAME}[\"']?[:=]+>?"
         rf"(?=\"([^\"]+)|'([^']+)|((?:(?!{NEXT})[^\"'])(?:(?!{NEXT}).)*))")
KEY_INSIDE = (r"(?<![A-Za-z0-9])(A(?:KIA|SIA)[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{30,}"
              r"|sk[-_][A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}"
              r"|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}[A-Za-z0-9_.-]*)")
URL_PASSWORD = rf"://[^/?#:@]*:([^/]{{{MIN_ASSIGNED},}})@"
# Texts without a match of these hold no candidate: whatever `candidates` takes
# is a run with a digit, follows a secret's name, or is a URL's password. A run
# is looked for around its digits, a secret's name where a word of it stands.
HOLDS_RUN = "[0-9](?:" + "|".join(
    rf"(?<={RUN}{{{before + 1}}})(?={RUN}{{{MIN_LENGTH - 1 - before}}})" for before in range(MIN_LENGTH)) + ")"
HOLDS_NAMED = rf"(?<!{NAME_CHAR})(?={NAME_CHAR}*+[\"']?[:=]){NAME_CHAR}*?{SECRET_NAME}"
NAME_WORDS = ["pass", "pwd", "secret", "token", "key", "credential"]
LONE_SEPARATOR = r"(?:^|[\x00-\x20])[:=]+>?[\x00-\x20]"
CLASSES = {"v": "aeiou", "c": "bcdfghjklmnpqrstvwxyz", "U": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "9": "0123456789"}


def holds_candidate() -> Column:
    """Whether ``text`` may hold a candidate: true for every text that
    `candidates` finds one in; null for null. Plain searches come before the
    patterns that need them."""
    text = F.col("text")
    lowered = F.lower(text)
    named = reduce(Column.__or__, [lowered.contains(w) for w in NAME_WORDS]) & (text.contains("=") | text.contains(":"))
    return (text.rlike(HOLDS_RUN) | (text.contains("://") & text.contains("@") & text.rlike(URL_PASSWORD))
            | (named & (text.rlike(HOLDS_NAMED) | (text.rlike(LONE_SEPARATOR) & text.rlike(SECRET_NAME)))))


def candidates(docs: DataFrame, checked: bool = False) -> DataFrame:
    """(rid, doc_id, path, at, value, name, before, after, assigned) of every
    candidate; ``docs`` has doc_id, path and text. ``checked``: `holds_candidate`
    is known to be true of every text."""
    if not checked:
        docs = docs.filter(holds_candidate())
    texts = (docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                         F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), "text")
                 .withColumn("w", F.split("text", r"[\x00-\x20]+")))
    hit = F.expr(f"""
        filter(transform(w, (x, i) -> named_struct('at', i, 'word', x,
                 'two', coalesce(get(w, i - 2), ''), 'before', coalesce(get(w, i - 1), ''),
                 'after', coalesce(get(w, i + 1), ''))),
               s -> length(s.word) >= {MIN_ASSIGNED})""")
    found = texts.select("rid", "doc_id", "path", F.inline(hit))
    found = (found.withColumn("bare", F.regexp_replace("word", r"^[^A-Za-z0-9]+|[^A-Za-z0-9+/=]+$", ""))
                  .withColumn("told", F.col("before").rlike(rf"(?<!{NAME_CHAR})(?={NAME_CHAR}*+[\"']?[:=]+>?$){NAME_CHAR}*?{SECRET_NAME}")
                              | (F.col("before").rlike(r"^([:=]+|:=|=>)$") & F.col("two").rlike(SECRET_NAME))))

    def every(pattern: str, group: int) -> Column:
        return F.regexp_extract_all("bare", F.lit(pattern), F.lit(group))

    def part(value: Column, name: Column, sure: bool) -> Column:
        return F.struct(F.regexp_replace(value, r"[^A-Za-z0-9+/=]+$", "").alias("value"), name.alias("name"),
                        F.lit(sure).alias("sure"))

    none = F.lit("")
    named = F.transform(F.arrays_zip(*(every(NAMED, g).alias(f"g{g}") for g in range(1, 5))),
                        lambda x: part(F.concat(x["g2"], x["g3"], x["g4"]), x["g1"], False))
    whole = F.when(F.col("bare").rlike(rf"^[A-Za-z]{NAME_CHAR}*+[\"']?[:=]+>?[^:=]"), F.array().cast(
        "array<struct<value:string,name:string,sure:boolean>>")).otherwise(F.array(part(F.col("bare"), none, False)))
    runs = F.filter(F.transform(every(rf"{RUN}{{{MIN_LENGTH},}}", 0), lambda x: part(x, none, False)),
                    lambda x: ~x["value"].rlike(rf"^[A-Za-z]{NAME_CHAR}*+=+[^=]"))
    keys = F.transform(every(KEY_INSIDE, 1), lambda x: part(x, none, False))
    passwords = F.transform(every(URL_PASSWORD, 1), lambda x: part(x, none, True))
    parts = found.withColumn("part", F.explode(F.concat(whole, named, runs, keys, passwords))).select(
        "rid", "doc_id", "path", "at", "before", "two", "after", "part.value", "part.name",
        (F.col("part.sure") | F.col("told") | F.col("part.name").rlike(SECRET_NAME)).alias("assigned"))
    kept = parts.filter(((F.length("value") >= MIN_LENGTH) & F.col("value").rlike("[0-9]")
                         & F.col("value").rlike(rf"^{RUN}+$"))
                        | (F.col("assigned") & (F.length("value") >= MIN_ASSIGNED)))
    # One finding per word and value, the assigned and named form first.
    best = F.max(F.struct("assigned", "name")).alias("best")
    others = ["doc_id", "path", "before", "two", "after"]
    return (kept.groupBy("rid", "at", "value").agg(best, *(F.first(c).alias(c) for c in others))
                .select("rid", "doc_id", "path", "at", "value", "best.name", "before", "two", "after", "best.assigned"))


def dictionary(spark: SparkSession, path: str = DICTIONARY) -> DataFrame:
    """Whole words of three letters or more of a public vocabulary (its size
    bounds the frame: some tens of thousands)."""
    with open(path, encoding="utf-8") as f:
        pieces = json.load(f)["model"]["vocab"]
    words = sorted({p[:-4] for p in pieces if p.endswith("</w>") and len(p) > 6 and p[:-4].isalpha() and p.isascii()})
    return spark.createDataFrame([(w,) for w in words], "word string")


def with_features(found: DataFrame, words: DataFrame) -> tuple[DataFrame, list[str]]:
    """``found`` with feature columns, and their names."""
    runs = found.select("rid", "at", "value", F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0)))).alias("word"))
    covered = (runs.join(F.broadcast(words), "word").groupBy("rid", "at", "value")
                   .agg(F.sum(F.length("word")).alias("covered")))
    out = found.join(covered, ["rid", "at", "value"], "left")
    n = F.length("value").cast("double")
    matching = "".join(CLASSES.values())
    shape = F.translate("value", matching, "".join(k * len(v) for k, v in CLASSES.items()))
    out = out.withColumn("shape", F.regexp_replace(shape, "[^vcU9]", "s"))

    def share(pattern: str) -> Column:
        return F.regexp_count("value", F.lit(pattern)) / n

    features = {
        "f_length": F.least(n, F.lit(200.0)),
        "f_digits": share("[0-9]"), "f_upper": share("[A-Z]"), "f_lower": share("[a-z]"),
        "f_hex": share("[0-9a-fA-F]"), "f_dots": share("[.]"), "f_at": share("@"),
        "f_distinct": F.size(F.array_distinct(F.split("value", ""))) / n,
        "f_dictionary": F.coalesce(F.col("covered"), F.lit(0)) / n,
        "f_named": (F.col("name") != "").cast("double"),
        "f_assigned": F.col("assigned").cast("double"),
        "f_assigns_before": F.col("before").rlike(r"[:=]+$").cast("double"),
        "f_secret_near": (F.concat_ws(" ", "two", "before", "after").rlike(SECRET_NAME)).cast("double"),
        "f_example_near": (F.concat_ws(" ", "two", "before", "after", "name").rlike(EXAMPLE)).cast("double"),
        "f_path_depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "f_path_example": F.col("path").rlike(EXAMPLE).cast("double"),
        "f_before_slot": F.pmod(F.xxhash64(F.lower("before")), F.lit(NEIGHBOUR_SLOTS)).cast("double"),
        "f_after_slot": F.pmod(F.xxhash64(F.lower("after")), F.lit(NEIGHBOUR_SLOTS)).cast("double"),
    }
    kinds = [*CLASSES, "s"]
    for a in kinds:
        for b in kinds:
            # The column's name tells upper from lower case by the class's place.
            features[f"f_from{kinds.index(a)}to{kinds.index(b)}"] = (
                F.regexp_count("shape", F.lit(f"{a}(?={b})")) / F.greatest(n - 1, F.lit(1.0)))
    return out.withColumns(features), list(features)


def format_label() -> Column:
    """1, 0 or null (undecided) by format and assignment."""
    value = F.col("value")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike("@") & (F.length("value") >= MIN_LENGTH)
    plain = value.rlike("@") | value.rlike(r"^[0-9.+/_=~-]+$") | (F.col("f_dictionary") >= 0.6)
    return F.when(value.rlike(KEY_FORMAT) | (F.col("assigned") & mixed & ~F.col("f_example_near").cast("boolean")), 1) \
            .when(~F.col("assigned") & plain, 0)


def bounded(labelled: DataFrame, most: int) -> DataFrame:
    """At most ``most`` findings of each label, by hash order."""
    each = [labelled.filter(F.col("label") == label).orderBy(F.xxhash64("value", "rid", "at"), "rid", "at").limit(most)
            for label in (0, 1)]
    return reduce(DataFrame.union, each)


def scan_secrets(docs: DataFrame, labels: DataFrame | None = None, dictionary_path: str = DICTIONARY,
                 checked: bool = False) -> DataFrame:
    """(rid, doc_id, path, at, value, rule, score, is_secret) per candidate:
    ``at`` is the word's number (a word may hold several values), ``score`` the forest's probability.

    ``docs`` has doc_id, path and text; ``labels`` (value, label 0/1), where
    given, are the labelled findings to train on.
    """
    found = stored(candidates(docs, checked), "secret-candidates")
    featured, names = with_features(found, dictionary(docs.sparkSession, dictionary_path))
    rule = (F.when(F.col("value").rlike(KEY_FORMAT), "key format").when(F.col("assigned"), "assigned")
             .otherwise("long mixed word"))
    featured = stored(featured.withColumn("format_label", format_label()).withColumn("rule", rule), "secret-features")
    if labels is None:
        labelled = featured.filter("format_label is not null").withColumn("label", F.col("format_label").cast("double"))
    else:
        given = labels.groupBy("value").agg(F.max("label").cast("double").alias("label"))
        labelled = featured.join(given, "value")
    train = stored(bounded(labelled.select("value", "rid", "at", *names, "label"), TRAIN_FINDINGS).coalesce(1),
                   "secret-training")
    vectors = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    keep = ["rid", "doc_id", "path", "at", "value", "rule"]
    if train.select("label").distinct().count() < 2:
        score = F.coalesce(F.col("format_label"), F.lit(0)).cast("double")
        return featured.select(*keep, score.alias("score"), (score >= THRESHOLD).cast("int").alias("is_secret"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features",
                                    labelCol="label").fit(vectors.transform(train.orderBy("label", "value", "rid", "at")))
    scored = forest.transform(vectors.transform(featured))
    score = vector_to_array("probability")[1]
    return scored.select(*keep, score.alias("score"), (score >= THRESHOLD).cast("int").alias("is_secret"))


def mask_secrets(docs: DataFrame, dictionary_path: str = DICTIONARY) -> DataFrame:
    """``docs`` with every found secret masked in its text, ``n_chars``, where
    there is such a column, counted anew. No document is dropped. Every row goes
    by its own text, whatever its doc_id: a value that is found in a text is
    masked in the rows of that very text and in no other. Texts are searched
    for candidates once; only those that may hold one are joined with the
    findings."""
    held = stored(docs.withColumn("__holds", F.coalesce(holds_candidate(), F.lit(False))), "held")
    some = held.filter("__holds").withColumn("__text", F.sha2("text", 256))
    texts = some.select(F.col("__text").alias("doc_id"), F.col("source").alias("path"), "text")
    secrets = (scan_secrets(texts, dictionary_path=dictionary_path, checked=True)
               .filter("is_secret = 1").groupBy(F.col("doc_id").alias("__of"))
               .agg(F.array_sort(F.collect_set("value"), lambda a, b: F.length(b) - F.length(a)).alias("__secrets")))
    masked = F.aggregate("__secrets", F.col("text"), lambda text, s: F.replace(text, s, F.lit(MASK)))
    some = some.join(secrets, F.col("__text") == F.col("__of"), "left")
    some = some.withColumn("text", F.when(F.col("__secrets").isNull(), F.col("text")).otherwise(masked))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        some = some.withColumn("n_chars", F.when(F.col("__secrets").isNull(), F.col("n_chars"))
                               .otherwise(F.length("text").cast(kind)))
    return held.filter("not __holds").select(docs.columns).unionByName(some.select(docs.columns))


def q_secrets(spark, sf_dir):
    from pricetide.llm.common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("path"), "text")
    return scan_secrets(docs).select("doc_id", "at", F.sha2("value", 256).alias("secret_sha256"),
                                     F.length("value").alias("length"), "rule", "score", "is_secret")
