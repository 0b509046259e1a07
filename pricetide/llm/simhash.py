"""SimHash near-duplicates by the generalised pigeonhole principle.

*Fingerprints.* A text's words (split at ASCII white space, A-Z lower-cased)
give all runs of ``shingle`` words, repeats included; a fingerprint bit is set
if over half of their XXH64 values (seed 42) have it set.

*Candidates.* The 64 bits are cut into m partitions, correlated bits together.
With thresholds t_i and sum(t_i + 1) = max_bits + 1, two fingerprints within
``max_bits`` must differ in at most t_i bits of some partition i. Partitions
and thresholds (-1: the partition isn't probed) are chosen by dynamic
programming on estimated candidate counts; the estimate uses a sample of
``PLAN_SAMPLE`` fingerprints and steers only the cost, every choice finds all
links. Each distinct fingerprint is indexed under its bits in each probed
partition and probes the values up to t_i bits away (an odd number of flips
only from the side of even parity).

*Verification* is exact and emits a spanning set of links, never all pairs of a
group: rows with one key meet in one task, in blocks; an index list longer than
``CHUNK`` is dealt over several tasks, and everything else under that key is
sent to each of them. Copies share one fingerprint and are one node.

Defined results: a null, empty or blank text has fingerprint zero and links
like any other; a text shorter than a shingle is one shingle. A row with null
doc_id takes part, but never names its component while a row with an id is in
it. Repeated rows are copies of each other. An empty table gives an empty one.
"""

from __future__ import annotations

import itertools
import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import slices, stored, text_key
from pricetide.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
PLAN_SAMPLE = 2048
CHUNK = 32_768        # index entries of one key that one task compares
SMALL_PAIRS = 4_096   # groups up to this many pairs are compared all at once
SPAN = 65_536         # shingles hashed at once


def fingerprint(data: bytes, shingle: int) -> int:
    """Signed 64-bit fingerprint of UTF-8 ``data``."""
    words = data.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    runs = (map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle
            else iter([b" ".join(words)]))
    hashes = map(xxhash.xxh64_intdigest, runs, itertools.repeat(42))
    set_bits = np.zeros(64, np.int64)
    for start in range(0, n, SPAN):
        h = np.fromiter(itertools.islice(hashes, min(SPAN, n - start)), np.uint64)
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n).view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, text_hash2, fp) of every row of ``docs`` (doc_id, text)."""

    def scan(batches):
        for batch in slices(batches):
            texts = batch.column(3).cast(pa.binary())
            fps = [fingerprint(t.as_py() or b"", shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps, pa.int64())],
                                             names=["doc_id", "text_hash", "text_hash2", "fp"])

    kept = docs.select("doc_id", *text_key(F.col("text"), ("text_hash", "text_hash2")), "text")
    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(scan, f"doc_id {kind}, text_hash long, text_hash2 long, fp long")


# -- partitions and thresholds -----------------------------------------------

def correlated_partitions(bits: np.ndarray, m: int) -> list[list[int]]:
    """The 64 columns of ``bits`` (rows of 0/1) in ``m`` lists of near-equal
    length; each list grows by the bit most correlated with its members."""
    x = bits - bits.mean(axis=0)
    scale = np.sqrt((x * x).sum(axis=0)) + 1e-9
    near = np.abs(x.T @ x) / np.outer(scale, scale)
    left, out = list(range(64)), []
    for i in range(m):
        size = 64 // m + (i < 64 % m)
        own = [left.pop(0)]
        while len(own) < size:
            best = max(left, key=lambda b: (near[own, b].sum(), -b))
            left.remove(best)
            own.append(best)
        out.append(sorted(own))
    return out


def estimated_rates(bits: np.ndarray, part: list[int], max_bits: int) -> list[float]:
    """P(two fingerprints differ in at most t bits of ``part``) for t up to
    ``max_bits``: the larger of the sample's pairs and of independent bits."""
    share = bits[:, part].mean(axis=0)
    law = np.zeros(len(part) + 1)
    law[0] = 1.0
    for q in 2 * share * (1 - share):
        law[1:] = law[1:] * (1 - q) + law[:-1] * q
        law[0] *= 1 - q
    n = len(bits)
    value = bits[:, part].astype(np.int32)
    ones = value.sum(axis=1)
    apart = ones[:, None] + ones[None, :] - 2 * (value @ value.T)
    seen = np.bincount(apart.ravel(), minlength=65)
    seen[0] -= n
    pairs = max(1, n * (n - 1))
    return [max(float(law[: t + 1].sum()), float(seen[: t + 1].sum()) / pairs) for t in range(max_bits + 1)]


def plan_partitions(sample: np.ndarray, n: int, max_bits: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the cheapest cut for ``n`` fingerprints."""
    bits = ((sample.astype(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    if not len(bits):
        bits = np.zeros((1, 64))
    best: tuple[float, list] = (math.inf, [])
    for m in range(2, max_bits + 2):
        parts = correlated_partitions(bits, m)
        costs = []
        for part in parts:
            rates = estimated_rates(bits, part, max_bits)
            costs.append([0.0] + [n * sum(math.comb(len(part), j) for j in range(t + 1)) + n * n * rates[t] / 20
                                  for t in range(max_bits + 1)])
        # table[u]: least cost so far with sum(t_i + 1) = u, and the choices
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for row in costs:
            grown: dict[int, tuple[float, list[int]]] = {}
            for u, (cost, chosen) in table.items():
                for step in range(max_bits + 2 - u):
                    new = (cost + row[step], [*chosen, step - 1])
                    if u + step not in grown or new[0] < grown[u + step][0]:
                        grown[u + step] = new
            table = grown
        cost, chosen = table[max_bits + 1]
        if cost < best[0]:
            best = (cost, list(zip(parts, chosen)))
    return [(part, t) for part, t in best[1] if t >= 0]


# -- probing and verification -------------------------------------------------

def _long(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _mask(bits) -> int:
    return _long(sum(1 << b for b in bits))


def _spanning(index: np.ndarray, label: np.ndarray, rows: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect ``rows`` and ``index`` as far as they are within
    ``max_bits``; ``label`` remembers which index entries are connected."""
    out = []
    block = max(1, 4_000_000 // max(1, len(index)))
    for start in range(0, len(rows), block):
        part = rows[start:start + block]
        close = np.bitwise_count(part[:, None] ^ index[None, :]) <= max_bits
        for i in np.flatnonzero(close.any(axis=1)).tolist():
            near = np.flatnonzero(close[i])
            groups, member = np.unique(label[near], return_index=True)
            for group, j in zip(groups, near[member]):
                if part[i] != index[j]:
                    out.append((part[i], index[j]))
                if group != groups[0]:
                    label[label == group] = groups[0]
    return out


def _link_stream(max_bits: int):
    """Rows (part, key, salt, role, fp), sorted, index entries (role 0) first
    within a key -> links (a, b)."""

    def scan(batches):
        carry = None
        open_key, index, label = None, None, None  # a group too long to be held

        def finish(keys, roles, fps, whole):
            """Links of the groups in these rows; the last one stays open
            unless ``whole``."""
            nonlocal open_key, index, label
            out_a, out_b = [], []
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            starts = np.concatenate(([0], cut))
            ends = np.concatenate((cut, [len(keys)]))
            if open_key is not None:
                if (keys[0] == open_key).all():
                    for a, b in _spanning(index, label, fps[:ends[0]], max_bits):
                        out_a.append([a])
                        out_b.append([b])
                    starts, ends = starts[1:], ends[1:]
                    if len(starts) or whole:
                        open_key = None
                else:
                    open_key = None
            if not len(starts):
                return out_a, out_b
            entries = np.add.reduceat((roles == 0).astype(np.int64), starts)
            sizes = ends - starts
            pairs = entries * sizes
            small = (pairs <= SMALL_PAIRS) & (entries > 0) & (sizes > 1)
            if small.any():
                s, e, n = starts[small], entries[small], sizes[small]
                row = np.concatenate([np.arange(a, a + c) for a, c in zip(s.tolist(), n.tolist())])
                per_row, first = np.repeat(e, n), np.repeat(s, n)
                right = np.repeat(row, per_row)
                offset = np.arange(len(right)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
                left = np.repeat(first, per_row) + offset
                keep = left < right
                a, b = fps[left[keep]], fps[right[keep]]
                near = (np.bitwise_count(a ^ b) <= max_bits) & (a != b)
                out_a.append(a[near])
                out_b.append(b[near])
            for g in np.flatnonzero((pairs > SMALL_PAIRS) & (entries > 0)).tolist():
                rows = fps[starts[g]:ends[g]]
                own = rows[:entries[g]].copy()
                names = np.arange(len(own))
                for a, b in _spanning(own, names, rows, max_bits):
                    out_a.append([a])
                    out_b.append([b])
                if g == len(starts) - 1 and not whole:
                    open_key, index, label = keys[starts[g]].copy(), own, names
            return out_a, out_b

        def links(out):
            out_a, out_b = out
            if not out_a:
                return None
            a = np.concatenate(out_a).astype(np.uint64).view(np.int64)
            b = np.concatenate(out_b).astype(np.uint64).view(np.int64)
            return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keys = np.stack([cols[0].astype(np.int64), cols[1], cols[2].astype(np.int64)], 1)
            roles, fps = cols[3], cols[4].view(np.uint64)
            if carry is not None:
                keys, roles, fps = (np.concatenate(p) for p in zip(carry, (keys, roles, fps)))
            last = np.flatnonzero((keys != keys[-1]).any(axis=1))
            whole_to = int(last[-1]) + 1 if len(last) else 0
            if whole_to:
                found = links(finish(keys[:whole_to], roles[:whole_to], fps[:whole_to], True))
                if found is not None:
                    yield found
            keys, roles, fps = keys[whole_to:], roles[whole_to:], fps[whole_to:]
            carry = (keys, roles, fps)
            if len(fps) > 2 * CHUNK and (roles[-1] != 0 or open_key is not None):
                # Index entries are complete: compare what is here, keep only them.
                found = links(finish(keys, roles, fps, False))
                carry = None
                if found is not None:
                    yield found
        if carry is not None:
            found = links(finish(*carry, True))
            if found is not None:
                yield found

    return scan


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fps``: one row per distinct ``fp``. Links (a, b) of fingerprints that
    differ in at most ``max_bits`` bits, enough to connect all that do."""
    n = fps.count()
    sample = np.array([r.fp for r in fps.orderBy(F.xxhash64("fp")).limit(PLAN_SAMPLE).collect()], np.int64)
    plan = plan_partitions(sample, n, max_bits)
    entries, probes = [], []
    for i, (bits, t) in enumerate(plan):
        value = F.col("fp").bitwiseAND(F.lit(_mask(bits)).cast("long"))
        entries.append(fps.select(F.lit(i).alias("part"), value.alias("key"), "fp"))
        if t > 0:
            flips = F.array(*[F.lit(_mask(c)).cast("long") for j in range(1, t + 1) for c in combinations(bits, j)])
            probes.append(fps.select(F.lit(i).alias("part"), value.alias("value"), "fp", F.explode(flips).alias("flip"))
                          .filter((F.bit_count("flip") % 2 == 0) | (F.bit_count("value") % 2 == 0))
                          .select("part", F.col("value").bitwiseXOR(F.col("flip")).alias("key"), "fp"))
    index = entries[0]
    for more in entries[1:]:
        index = index.union(more)
    # Keys with more index entries than one task compares: a row for every
    # CHUNK entries at most. How it is joined is left to its measured size.
    hot = (index.groupBy("part", "key").count().filter(F.col("count") > CHUNK)
                .select("part", "key", F.ceil(F.col("count") / CHUNK).cast("int").alias("tasks")))
    hot = stored(hot, "hot-keys")
    hot_rows = hot.limit(1).collect()
    rows = index.select("part", "key", F.lit(0).alias("salt"), F.lit(0).alias("role"), "fp")
    others = [p.select("part", "key", F.lit(0).alias("salt"), F.lit(1).alias("role"), "fp") for p in probes]
    if hot_rows:
        own = F.pmod(F.xxhash64("fp"), F.col("tasks")).cast("int")
        dealt = index.join(hot, ["part", "key"], "left")
        rows = dealt.select("part", "key", F.coalesce(own, F.lit(0)).alias("salt"), F.lit(0).alias("role"), "fp")
        every = F.explode(F.sequence(F.lit(0), F.coalesce("tasks", F.lit(1)) - 1))
        others = [p.join(hot, ["part", "key"], "left").select("part", "key", every.alias("salt"),
                                                              F.lit(1).alias("role"), "fp") for p in probes]
        others.append(dealt.filter("tasks is not null")
                      .select("part", "key", own.alias("own"), every.alias("salt"), "fp").filter("salt != own")
                      .select("part", "key", "salt", F.lit(1).alias("role"), "fp"))
    for more in others:
        rows = rows.union(more)
    return (rows.repartition("part", "key", "salt").sortWithinPartitions("part", "key", "salt", "role", "fp")
                .mapInArrow(_link_stream(max_bits), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, doc_id, text_hash, text_hash2, group, component_id) for every row of ``docs``:
    ``group`` names the component by a fingerprint, ``component_id`` by the
    smallest doc_id reachable over links of at most ``max_bits`` bits."""
    each = stored(fingerprints(docs, shingle), "fingerprints")
    distinct = stored(each.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    links = fingerprint_links(distinct.select("fp"), max_bits)
    nodes = connected_components(links)
    named = distinct.join(nodes, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("group"))
    smallest = named.groupBy("group").agg(F.min("least").alias("component_id"))
    return each.join(named.join(smallest, "group").select("fp", "group", "component_id"), "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest
    doc_id, of several such texts the one with the smallest hash. Every row
    belongs to the group of its own text, whatever its doc_id: rows that share an
    id but not a group are kept or dropped independently. A row without an id
    stays only where no row of its group has one. Of rows alike in doc_id and
    text any one stays."""
    found = near_duplicates(docs, shingle, max_bits)
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "text_hash2")
    stay = found.groupBy("group").agg(F.min(row).alias("s")).select(
        F.col("s.doc_id").alias("__id"), F.col("s.text_hash").alias("__h1"), F.col("s.text_hash2").alias("__h2"))
    keyed = docs.select("*", *text_key(F.col("text"), ("__t1", "__t2")))
    kept = keyed.join(stay, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__t1") == F.col("__h1"))
                      & (F.col("__t2") == F.col("__h2")), "left_semi")
    # First of each in every task, before rows are shuffled: copies of a row
    # meet as one row a task.
    return kept.dropDuplicates(["doc_id", "__t1", "__t2"]).drop("__t1", "__t2")


def q_simhash(spark, sf_dir):
    from pricetide.llm.common import read

    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
