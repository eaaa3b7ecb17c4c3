"""Exact top-k inner-product search with ball trees.

Vectors are dealt into shards of bounded size. A shard becomes a ball tree: its vectors in
leaf order and, for each node, centre and radius. No vector of a node has a larger inner
product with a query than <query, centre> + |query| * radius. Queries go to every shard in
blocks; a block walks a tree from the node with the largest bound to the smallest and leaves
out nodes, and queries at a node, whose bound is below the k-th score so far. That score is
shared: shards are searched in waves of 1, 1, 2, 4 and so on, and queries start each wave with
the k-th score found in all waves before, so most nodes of later shards are never opened.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from advisory_lake.llm.shared import ship_package, written

SHARD_ROWS = 16_384
BLOCK_QUERIES = 8_192
QUERIES_AT_ONCE = 64  # walk a tree together
LEAF_ROWS = 64
_EXACT = float(1 << 53)  # whole numbers up to here are exact in doubles


def ball_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row order, nodes (start, stop, left, right; -1 for leaves), centres and radii."""
    order = np.arange(len(vectors))
    nodes, centres, radii = [], [], []
    waiting = [(0, len(vectors), -1, 0)]
    while waiting:
        start, stop, parent, side = waiting.pop()
        own = vectors[order[start:stop]]
        centre = own.mean(axis=0)
        at = len(nodes)
        nodes.append([start, stop, -1, -1])
        centres.append(centre)
        radii.append(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
        if parent >= 0:
            nodes[parent][2 + side] = at
        if stop - start > LEAF_ROWS and radii[-1] > 0:
            # split between two far points, at the median so that equal rows end as well
            one = own[((own - centre) ** 2).sum(axis=1).argmax()]
            two = own[((own - one) ** 2).sum(axis=1).argmax()]
            by = np.argsort(own @ (two - one), kind="stable")
            order[start:stop] = order[start:stop][by]
            middle = (start + stop) // 2
            waiting += [(start, middle, at, 0), (middle, stop, at, 1)]
    return order, np.array(nodes), np.array(centres), np.array(radii)


def inner_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Whole numbers, exact for whole inputs of any size; beyond 64 bits an error."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    if np.abs(queries).max() * np.abs(vectors).max() * queries.shape[1] < _EXACT:
        return (queries @ vectors.T).astype(np.int64)
    a, b = ([[int(x) for x in row] for row in rows] for rows in (queries, vectors))
    return np.array([[sum(x * y for x, y in zip(p, q)) for q in b] for p in a], dtype=np.int64)


def search(queries: np.ndarray, query_ids: np.ndarray, least: np.ndarray, shard: pd.DataFrame, k: int) -> list[list[tuple[int, int]]]:
    """The best k (score, vec_id) of a shard for each query, none below ``least``; ties to the
    smaller vec_id. Rows with the id of the query take no part."""
    vectors = np.stack(shard["vector"].to_numpy()) if len(shard) else np.empty((0, queries.shape[1]))
    ids = shard["vec_id"].to_numpy()
    order, nodes, centres, radii = ball_tree(vectors)
    vectors, ids = vectors[order], ids[order]
    best: list[list[tuple[int, int]]] = []
    for start in range(0, len(queries), QUERIES_AT_ONCE):
        part = slice(start, start + QUERIES_AT_ONCE)
        best += _walk(queries[part], query_ids[part], least[part].astype(float), vectors, ids, nodes, centres, radii, k)
    return best


def _walk(queries, query_ids, least, vectors, ids, nodes, centres, radii, k):
    found: list[list[tuple[int, int]]] = [[] for _ in queries]  # heaps of (score, -vec_id)
    lengths = np.sqrt((queries**2).sum(axis=1))
    bounds = queries @ centres.T + lengths[:, None] * radii
    # rounding can lift a score above its bound by far less than this
    bounds += 1e-9 * (lengths[:, None] * (np.sqrt((centres**2).sum(axis=1)) + radii)) + 1e-6
    heap = [(-(bounds[:, 0] - least).max(), 0)]
    while heap:
        _, node = heapq.heappop(heap)
        asking = np.flatnonzero(bounds[:, node] >= least)
        if not len(asking):
            continue
        start, stop, left, right = nodes[node]
        if left >= 0:
            for child in (left, right):
                gain = (bounds[asking, child] - least[asking]).max()
                if gain >= 0:
                    heapq.heappush(heap, (-gain, child))
            continue
        scores = inner_products(queries[asking], vectors[start:stop])
        own = ids[start:stop]
        for q, row in zip(asking, scores):
            kept = found[q]
            for i in np.flatnonzero((row >= least[q]) & (own != query_ids[q])):
                entry = (int(row[i]), -int(own[i]))
                if len(kept) < k:
                    heapq.heappush(kept, entry)
                elif entry > kept[0]:
                    heapq.heapreplace(kept, entry)
            if len(kept) == k:
                least[q] = max(least[q], kept[0][0])
    return [[(score, -negative) for score, negative in sorted(kept, reverse=True)] for kept in found]


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and floor(scale * x) of every component x as double; rows without vec_id, null
    vectors and those with a null or non-finite component are left out."""
    ship_package(vectors.sparkSession)
    doubles = F.col("embedding").cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(doubles, lambda x: F.floor(x * scale).cast("double")).alias("vector"),
    )


def _numbers(low: int, high: int):
    """Repeat a row for every number."""
    return F.explode(F.sequence(F.lit(low).cast("long"), F.lit(high).cast("long")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for every query (vec_id, vector) its k highest inner
    products among ``vectors`` (vec_id, vector), all if there are fewer.

    Vectors hold whole numbers as doubles. Ties go to the smaller vec_id; a query does not find
    rows with its own id. Only vectors with as many components as the query take part. Rows that
    repeat an id with another vector are candidates of their own, and queries of their own.
    """
    def sized(df):
        return df.select("vec_id", "vector", F.size("vector").alias("size"))

    candidates, asked = written(sized(vectors), "vectors"), written(sized(queries).distinct(), "queries")
    shards = max(1, -(-candidates.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards))
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))
    # shards and blocks meet in pairs, each of bounded size
    dealt = candidates.withColumn("shard", shard).withColumn("block", _numbers(0, blocks - 1))
    asked = asked.withColumn("query", F.xxhash64("vec_id", "vector")).withColumn("block", block)

    def searched(low: int, high: int, asking: DataFrame) -> DataFrame:
        everywhere = asking.withColumn("shard", _numbers(low, high))

        def of_pair(key, rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
            hits = []
            if len(rows) and len(asks):
                given = np.stack(asks["vector"].to_numpy())
                least = asks["least"].fillna(-np.inf).to_numpy()
                for (query, vec_id), best in zip(
                    zip(asks["query"], asks["vec_id"]), search(given, asks["vec_id"].to_numpy(), least, rows, k)
                ):
                    hits += [(query, vec_id, i, score) for score, i in best]
            return pd.DataFrame(hits, columns=["query", "query_id", "vec_id", "score"]).astype("int64")

        keys = ["size", "shard", "block"]
        here = dealt.where(F.col("shard").between(low, high))
        return (
            here.groupBy(*keys)
            .cogroup(everywhere.groupBy(*keys))
            .applyInPandas(of_pair, "query LONG, query_id LONG, vec_id LONG, score LONG")
        )

    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best, low, high = None, 0, 0
    asking = asked.withColumn("least", F.lit(None).cast("double"))
    while low < shards:  # 1, 1, 2, 4 ... shards, each wave with the scores of all before it
        hits = searched(low, min(high, shards - 1), asking)
        hits = hits if best is None else hits.union(best)
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        low, high = high + 1, 2 * high + 1
        if low < shards:
            best = written(ranked.drop("rank"), "hits")
            full = best.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("least"))
            asking = asked.join(full.where(F.col("n") >= k).select("query", "least"), "query", "left")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
