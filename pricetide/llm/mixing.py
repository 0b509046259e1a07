"""Mixing sources to target weights by Pfair scheduling.

Every source's documents, in a fixed pseudo-random order, are cut into blocks
of ``block_docs``; one block fills one slot of the mix. A source of weight w
releases its block j (from 0) at slot floor(j / w) and must have it placed by
ceil((j + 1) / w); earliest deadline first meets every deadline when weights
add to one, so after any number t of slots a source has had its w t blocks to
within less than one block.

Weights are exact fractions p / Q, never rounded. Where Q is small (weights that
are multiples of a thousandth, thirds), one cycle's schedule, worked out from the
list of sources alone, serves all cycles; otherwise (the default weights) the
schedule has one row per block of the phase.
When a source has given its last block, a new *phase* begins in which the other
sources share the slots by their weights: every document is placed exactly
once. Documents are ranked within their source by counts per hash bucket and a
window within each bucket, so a source holding a third of all rows is split
over many tasks. The slots of a bucket's blocks join its documents in that
window, so the documents themselves are shuffled once for their place in the mix.

Defined results: a null source is a source of its own; a null doc_id is placed
like any other; rows with equal doc_id are ordered arbitrarily among
themselves; an empty table gives an empty mix; the text plays no part. A source
that ``weights`` doesn't name, or gives no positive weight, shares the smallest
positive weight, so that nothing is dropped.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_DOCS = 32
RESOLUTION = 1000      # slots of a cycle, where weights are whole shares of it
ALPHA = 0.7            # default target weights: size ** ALPHA
BUCKET_ROWS = 50_000   # rows of one ranking bucket, about
MIN_BUCKETS, MAX_BUCKETS = 64, 65_536


def whole(weights: Mapping) -> dict:
    """Whole numbers in the exact proportion of ``weights``: floats count as the
    shortest decimal that reads back as them, so 0.3 is three tenths."""
    exact = {s: Fraction(repr(float(w))) if isinstance(w, float) else Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * scale) for s, w in exact.items()}


def integer_shares(weights: Mapping, resolution: int) -> dict:
    """Whole shares in the exact proportion of ``weights``: of a cycle of
    ``resolution`` slots (four a source at least) where it holds them, else of
    the smallest cycle that does."""
    shares = weights if all(type(w) is int for w in weights.values()) else whole(weights)
    common = math.gcd(*shares.values())
    shares = {s: p // common for s, p in shares.items()}
    times, rest = divmod(max(resolution, 4 * len(shares)), sum(shares.values()))
    return shares if rest else {s: p * times for s, p in shares.items()}


def cycle(shares: Mapping, left: Mapping) -> list:
    """The source of each slot of one cycle, or of its slots until a source has
    given the blocks it has ``left``: earliest deadline first among the released
    blocks; ties go to the source's name."""
    q = sum(shares.values())
    waiting = [(0, str(s), s, 0) for s in shares]
    heapq.heapify(waiting)
    ready: list = []
    out = []
    while len(out) < q:
        while waiting and waiting[0][0] <= len(out):
            _, name, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * q // shares[s]), name, s, j))
        _, name, s, j = heapq.heappop(ready)
        out.append(s)
        if j + 1 == left[s]:
            break
        if j + 1 < shares[s]:
            heapq.heappush(waiting, ((j + 1) * q // shares[s], name, s, j + 1))
    return out


def phases(blocks: Mapping, weights: Mapping, resolution: int = RESOLUTION) -> tuple[list, list]:
    """([(source, phase, first block, blocks, share, cycle length, first slot)],
    [(source, phase, k, place of the cycle's k-th block)])."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    weights = whole({s: weights[s] for s in left})
    spans, places, slot, phase = [], [], 0, 0
    while left:
        shares = integer_shares({s: weights[s] for s in left}, resolution)
        q = sum(shares.values())
        at: dict = {s: [] for s in left}
        order = cycle(shares, left)
        for place, s in enumerate(order):
            at[s].append(place)
        # The phase ends with the last block of the first source to run out.
        end = len(order) if len(order) < q else min((n - 1) // shares[s] * q + at[s][(n - 1) % shares[s]] for s, n in left.items()) + 1
        for s in sorted(left, key=str):
            took = end // q * shares[s] + sum(p < end % q for p in at[s])
            if took:
                spans.append((s, phase, done[s], took, shares[s], q, slot))
                places += [(s, phase, k, p) for k, p in enumerate(at[s][:took])]
            done[s] += took
            left[s] -= took
        left = {s: n for s, n in left.items() if n > 0}
        slot += end
        phase += 1
    return spans, places


def mix(docs: DataFrame, weights: Mapping | None = None, block_docs: int = BLOCK_DOCS,
        resolution: int = RESOLUTION, alpha: float = ALPHA, seed: str = "mix") -> DataFrame:
    """``docs`` (with doc_id and source) plus ``mix_block`` (the block's number
    within its source), ``mix_slot`` and ``mix_position``, the place of the
    document in the mix. Input columns of those names are replaced.

    ``weights``: source -> target weight; by default size ** ``alpha``.
    """
    spark = docs.sparkSession
    docs = docs.drop("mix_block", "mix_slot", "mix_position")
    # One row per source: the mixture's own list, not the documents.
    sizes = {r[0]: r[1] for r in docs.groupBy("source").count().collect()}
    total = sum(sizes.values())
    target = ({s: float(n) ** alpha for s, n in sizes.items()} if weights is None
              else {s: float(weights.get(s) or 0.0) for s in sizes})
    least = min((w for w in target.values() if w > 0), default=1.0)
    target = {s: w if w > 0 else least for s, w in target.items()}
    spans, places = phases({s: -(-n // block_docs) for s, n in sizes.items()}, target, resolution)

    buckets = MIN_BUCKETS
    while buckets < MAX_BUCKETS and buckets * BUCKET_ROWS < total:
        buckets *= 2
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    bucket = F.floor(F.conv(F.substring("__key", 1, 4), 16, 10).cast("int") / (65_536 // buckets)).cast("int")
    keyed = docs.withColumn("__key", key).withColumn("__bucket", bucket)
    before = (keyed.groupBy("source", "__bucket").count()
                   .withColumn("__before", F.sum("count").over(Window.partitionBy("source").orderBy("__bucket"))
                               - F.col("count")))
    last = F.floor((F.col("__before") + F.col("count") - 1) / block_docs)
    blocks = (before.withColumn("__block", F.explode(F.sequence(F.floor(F.col("__before") / block_docs), last)))
                    .withColumn("__name", F.col("source").cast("string")))
    # Shares that no source uses up are beyond a long: their cycle isn't repeated.
    spans = [(s, phase, first, took, min(share, took), q if share < took else 0, slot)
             for s, phase, first, took, share, q, slot in spans]
    span = spark.createDataFrame(spans, "__s string, __phase int, __first long, __took long, __share long, __q long, "
                                        "__slot long")
    offset = spark.createDataFrame(places, "__s2 string, __phase2 int, __k long, __place long")
    step = F.col("__block") - F.col("__first")
    slots = (blocks.join(span, F.col("__name").eqNullSafe(F.col("__s")) & (step >= 0) & (step < F.col("__took")))
                   .withColumn("__turn", step % F.col("__share"))
                   .join(offset, F.col("__name").eqNullSafe(F.col("__s2"))
                         & (F.col("__phase") == F.col("__phase2")) & (F.col("__turn") == F.col("__k")))
                   .select("source", "__bucket", "__before", "__block",
                           (F.col("__slot") + F.floor(step / F.col("__share")) * F.col("__q") + F.col("__place"))
                           .alias("__at")))
    # A bucket's blocks lie beside its documents, so that these, whole texts maybe,
    # are shuffled once and joined to nothing: first all blocks, which tell
    # where the bucket begins, then each block before the documents that fill it.
    both = keyed.unionByName(slots, allowMissingColumns=True)
    bucket_rows = Window.partitionBy("source", "__bucket")
    is_doc = F.col("__block").isNull()
    place = bucket_rows.orderBy(is_doc, "__key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    ranked = both.select("*", (F.max("__before").over(place) + F.count(F.lit(1)).over(place)
                               - F.count("__block").over(place) - 1).alias("__rank"))
    ranked = ranked.withColumn("__index", F.when(is_doc, F.col("__rank")).otherwise(F.col("__block") * block_docs))
    filled = bucket_rows.orderBy("__index", is_doc).rowsBetween(Window.unboundedPreceding, 0)
    slotted = (ranked.withColumn("mix_slot", F.last("__at", ignorenulls=True).over(filled)).filter(is_doc)
                     .withColumn("mix_block", F.floor(F.col("__index") / block_docs).cast("long"))
                     .withColumn("mix_position", F.col("mix_slot") * block_docs + F.col("__index") % block_docs))
    return slotted.select(*docs.columns, "mix_block", F.col("mix_slot").cast("long").alias("mix_slot"),
                          F.col("mix_position").cast("long").alias("mix_position"))


def mixed_in_order(docs: DataFrame, **options) -> DataFrame:
    """The mix, dealt into files and rows in the order of ``mix_position``."""
    return mix(docs, **options).repartitionByRange("mix_position").sortWithinPartitions("mix_position")


def q_mixing(spark, sf_dir):
    from pricetide.llm.common import read

    return mix(read(spark, sf_dir, "documents").select("doc_id", "source"))
