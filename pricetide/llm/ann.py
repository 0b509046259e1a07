"""Nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt by a hash of their id into shards of about ``SHARD_ROWS``.
Every shard builds a tree: a node keeps a vantage vector and the median
distance mu of its vectors to it, the nearer half on the inside, the others
outside; a leaf keeps up to ``LEAF_ROWS`` vectors. The shard's trees are written
once and searched by blocks of about ``QUERY_BLOCK`` queries, one after the
other; a block is all that is broadcast. A query at distance d from the vantage vector, with tau the distance
of its k-th best so far, skips the other side of mu if

    |d - mu| * factor > tau

Factor one is the triangle inequality: nothing within tau is skipped and the
search is exact. A larger factor prunes more and may miss neighbours.

Distances that decide are squared sums of differences in double precision; the
winners are scored anew, in order of components, by SQL.

Defined results: vectors null, empty, zero or with null or non-finite components
take no part; only vectors of one length are compared; rows that share an id
and vector count once; a query's own id is never its neighbour; fewer than k
candidates give fewer rows; ties go to the smaller id; empty tables give no
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import stored

K = 10
FACTOR = 1.0
SHARD_ROWS = 8192
LEAF_ROWS = 256
QUERY_BLOCK = 4096
SHARDS_A_BATCH = 16  # shards that a task holds at once


def usable(vector: str | Column) -> Column:
    """Vectors that take part."""
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def build_tree(x: np.ndarray, leaf: int) -> dict[str, np.ndarray]:
    """Arrays of a vantage-point tree over the rows of ``x``: ``order`` lists
    the rows; node i covers order[start:end], has its vantage row at
    order[start] and its children's numbers (0: a leaf)."""
    order = np.arange(len(x))
    nodes: list[list] = []
    work = [(0, len(x), -1, 0)]
    while work:
        start, end, parent, side = work.pop()
        me = len(nodes)
        nodes.append([start, end, 0, 0, 0.0])
        if parent >= 0:
            nodes[parent][2 + side] = me
        if end - start <= leaf:
            continue
        pick = start + me * 2_654_435_761 % (end - start)  # spread, and the same on a retry
        order[[start, pick]] = order[[pick, start]]
        rest = order[start + 1:end]
        d = np.sqrt(((x[rest] - x[order[start]]) ** 2).sum(axis=1))
        half = len(rest) // 2
        by = np.argpartition(d, half)
        order[start + 1:end] = rest[by]
        nodes[me][4] = float(d[by[half]])
        work.append((start + 1 + half, end, me, 1))
        work.append((start + 1, start + 1 + half, me, 0))
    table = np.array(nodes, np.float64)
    return {"order": order.astype(np.int64), "nodes": table}


def search_tree(x: np.ndarray, ids: np.ndarray, tree: dict, queries: np.ndarray, query_ids: np.ndarray,
                k: int, factor: float, best_id: np.ndarray | None = None,
                best: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of the ``k`` nearest found per query, nearest first,
    missing ones as id -1 at infinity. ``best_id`` and ``best`` are what other
    trees gave. Queries descend together; each visits the side of mu that it
    lies on first."""
    order, nodes = tree["order"], tree["nodes"]
    best_id = np.full((len(queries), k), -1, np.int64) if best_id is None else best_id.copy()
    best = np.full((len(queries), k), np.inf) if best is None else best.copy()

    repeats = len(np.unique(ids)) < len(ids)

    def offer(q: np.ndarray, rows: np.ndarray, d: np.ndarray) -> None:
        d = np.where(ids[rows][None, :] == query_ids[q][:, None], np.inf, d)
        all_d = np.concatenate([best[q], d], axis=1)
        all_id = np.concatenate([best_id[q], np.broadcast_to(ids[rows], d.shape)], axis=1)
        rank = np.lexsort((all_id, all_d), axis=1)
        if repeats:
            # Of an id with several vectors the nearest counts.
            for i, by in enumerate(rank):
                _, first = np.unique(all_id[i, by], return_index=True)
                again = np.setdiff1d(np.arange(len(by)), first)
                all_d[i, by[again]] = np.inf
            rank = np.lexsort((all_id, all_d), axis=1)
        rank = rank[:, :k]
        best[q] = np.take_along_axis(all_d, rank, 1)
        best_id[q] = np.where(np.isinf(best[q]), -1, np.take_along_axis(all_id, rank, 1))

    def distances(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.empty((len(q), len(rows)))
        for start in range(0, len(q), 64):
            out[start:start + 64] = np.sqrt(
                ((queries[q[start:start + 64], None, :] - x[rows][None, :, :]) ** 2).sum(axis=2))
        return out

    def visit(node: int, q: np.ndarray) -> None:
        start, end, inside, outside = nodes[node, :4].astype(np.int64).tolist()
        mu = nodes[node, 4]
        if not inside and not outside:
            offer(q, order[start:end], distances(q, order[start:end]))
            return
        d = distances(q, order[start:start + 1])
        offer(q, order[start:start + 1], d)
        d = d[:, 0]
        near = d < mu
        for first, second, own in ((inside, outside, near), (outside, inside, ~near)):
            mine, gap = q[own], np.abs(d[own] - mu)
            if len(mine):
                visit(first, mine)
                # A rounding margin keeps neighbours at the very rim.
                more = gap * factor <= best[mine, -1] * (1 + 1e-9)
                if more.any():
                    visit(second, mine[more])

    if len(x) and len(queries):
        visit(0, np.arange(len(queries)))
    return best_id, best


def _matrix(column) -> np.ndarray:
    """A list column of equal lengths as a double matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(dim, shard, ids, data, tree_order, tree_nodes): one row per shard, of
    about ``shard_rows`` vectors, from (id, v) with usable vectors."""
    rows = vectors.select("id", "v").withColumn("dim", F.size("v"))
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = (rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
                 .repartition("dim", "shard"))

    def build(key, batch):
        x = batch.column("v").combine_chunks()
        ids = batch.column("id").to_numpy()
        x = _matrix(x)
        # Rows that share an id and a vector count once.
        # Whole numbers stay whole: as doubles, large ids would meet.
        order = np.lexsort((*x.T, ids))
        x, ids = x[order], ids[order]
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (ids[1:] != ids[:-1]) | (x[1:] != x[:-1]).any(axis=1)
        x, ids = x[fresh], ids[fresh]
        tree = build_tree(x, leaf_rows)
        return pa.table({"dim": [key[0].as_py()], "shard": [key[1].as_py()],
                         "ids": [ids.astype(np.int64).tobytes()], "data": [x.tobytes()],
                         "tree_order": [tree["order"].tobytes()], "tree_nodes": [tree["nodes"].tobytes()]})

    return dealt.groupBy("dim", "shard").applyInArrow(
        build, "dim long, shard long, ids binary, data binary, tree_order binary, tree_nodes binary")


def query_blocks(queries: DataFrame, block: int = QUERY_BLOCK):
    """(dim, ids, matrix) of about ``block`` queries at a time."""
    blocks = max(1, -(-queries.count() // block))
    dealt = stored(queries.withColumn("dim", F.size("v"))
                          .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")), "queries")
    for b in range(blocks):
        rows = dealt.filter(F.col("block") == b).orderBy("dim", "id").toArrow()
        for dim in sorted(set(rows.column("dim").to_pylist())):
            part = rows.filter(pa.compute.equal(rows.column("dim"), dim))
            yield dim, part.column("id").to_numpy(), _matrix(part.column("v").combine_chunks())


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR,
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) from two frames (id, v)."""
    spark = vectors.sparkSession
    ok = vectors.filter(F.col("id").isNotNull() & usable("v"))
    asked = queries.filter(F.col("id").isNotNull() & usable("v")).distinct()
    index = stored(build_index(ok, shard_rows), "vp-trees")
    found = None
    for dim, ids, matrix in query_blocks(asked):
        block = spark.sparkContext.broadcast((ids, matrix))

        def search(batches, block=block):
            query_ids, q = block.value
            # The best over all shards of the task: each shard begins with the
            # distance that those before it have reached.
            best_id, best = np.full((len(query_ids), k), -1, np.int64), np.full((len(query_ids), k), np.inf)
            for batch in batches:
                for row in batch.to_pylist():
                    own = np.frombuffer(row["ids"], np.int64)
                    x = np.frombuffer(row["data"], np.float64).reshape(len(own), -1)
                    tree = {"order": np.frombuffer(row["tree_order"], np.int64),
                            "nodes": np.frombuffer(row["tree_nodes"], np.float64).reshape(-1, 5)}
                    best_id, best = search_tree(x, own, tree, q, query_ids, k, factor, best_id, best)
            hit = best_id >= 0
            yield pa.record_batch([pa.array(np.repeat(query_ids, hit.sum(axis=1))), pa.array(best_id[hit]),
                                   pa.array(best[hit])], names=["query_id", "vec_id", "d"])

        # A row is a whole shard.
        met = index.filter(F.col("dim") == dim).mapInArrow(search, "query_id long, vec_id long, d double")
        part = stored(met.select("query_id", "vec_id"), "shard-neighbours", SHARDS_A_BATCH)
        block.destroy()  # one block of queries is on the executors at a time
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    a, b = (f.select(F.col("id").alias(i), F.col("v").alias(v)) for f, i, v in
            ((asked, "query_id", "qv"), (ok.distinct(), "vec_id", "v")))
    apart = F.zip_with("qv", "v", lambda x, y: (x.cast("double") - y.cast("double")))
    score = F.sqrt(F.aggregate(apart, F.lit(0.0), lambda acc, x: acc + x * x))
    scored = (found.join(a, "query_id").join(b, "vec_id").filter(F.size("qv") == F.size("v"))
                   .select("query_id", "vec_id", score.alias("score"))
                   .groupBy("query_id", "vec_id").agg(F.min("score").alias("score")))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")  # k rows a shard
    return (scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                  .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def q_neighbours(spark, sf_dir):
    from pricetide.llm.common import read

    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return nearest(rows, rows.filter(F.col("id") % 100 == 0))


Q_NEIGHBOURS_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         sqrt(list_sum(list_transform(list_zip(q.embedding, c.embedding),
              lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) * (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)))))
           AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.embedding) = len(c.embedding)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
