"""Hard negatives: for every anchor its nearest rows of the same label, and for each of these the
best rows of other labels whose scores lie in a window below.

Scores are inner products of whole numbers. Anchors in blocks meet candidates in blocks, one task
for each pair of blocks; their scores come from Strassen's recursive multiplication of int64
matrices, padded with zeros to even sides. Its additions and products are those of the integers
modulo 2**64, so that it is exact wherever the scores themselves fit; larger numbers are
multiplied as Python's integers. Heaps keep the first few of each anchor, positives in a first
pass and windows in a second, and heaps of different tiles merge into the heap of all.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from advisory_lake.llm.shared import ship_package, written

ANCHOR_BLOCK, CANDIDATE_BLOCK = 8_192, 8_192  # rows that meet in one task
ANCHORS_AT_ONCE = 512  # of a tile whose scores are in memory
CUTOFF = 32  # no side below this is halved again
POSITIVES, NEGATIVES = 5, 3


def strassen(a: np.ndarray, b: np.ndarray, cutoff: int = CUTOFF) -> np.ndarray:
    """The product of two integer matrices of any sides, by seven products of their quarters."""
    rows, inner, columns = len(a), len(b), b.shape[1]
    if min(rows, inner, columns) < 2 * cutoff:
        return a @ b
    a = np.pad(a, ((0, rows % 2), (0, inner % 2)))
    b = np.pad(b.T, ((0, columns % 2), (0, inner % 2))).T
    m, k, n = len(a) // 2, len(b) // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    result = np.zeros((2 * m, 2 * n), a.dtype)
    c11, c12, c21, c22 = result[:m, :n], result[:m, n:], result[m:, :n], result[m:, n:]
    # each product is added where it belongs, so that one at a time is in memory
    product = strassen(a11 + a22, b11 + b22, cutoff)
    c11 += product
    c22 += product
    product = strassen(a21 + a22, b11, cutoff)
    c21 += product
    c22 -= product
    product = strassen(a11, b12 - b22, cutoff)
    c12 += product
    c22 += product
    product = strassen(a22, b21 - b11, cutoff)
    c11 += product
    c21 += product
    product = strassen(a11 + a12, b22, cutoff)
    c11 -= product
    c12 += product
    c22 += strassen(a21 - a11, b11 + b12, cutoff)
    c11 += strassen(a12 - a22, b21 + b22, cutoff)
    return result[:rows, :columns]


def whole_numbers(anchors: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as int64 when no score can leave its range, else as Python's integers."""
    largest = [int(np.abs(side).max()) if side.size else 0 for side in (anchors, candidates)]
    if max(largest) < 1 << 62 and largest[0] * largest[1] * max(anchors.shape[1], 1) < 1 << 63:
        return anchors.astype(np.int64), candidates.astype(np.int64)
    return tuple(np.array([[int(x) for x in row] for row in side], object).reshape(side.shape) for side in (anchors, candidates))


class Best:
    """The first ``size`` of (score, id) pairs: higher scores first, then smaller ids."""

    def __init__(self, size: int):
        self.size, self.heap = size, []

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.size:
            # all that tie with the last one stay for now, whatever their number
            least = np.partition(scores, len(scores) - self.size)[len(scores) - self.size]
            kept = scores >= least
            scores, ids = scores[kept], ids[kept]
            first = np.lexsort((ids, -scores))[: self.size]
            scores, ids = scores[first], ids[first]
        self.merge(Best.of(zip(scores.tolist(), (-ids).tolist()), self.size))

    def merge(self, other: Best) -> None:
        for entry in other.heap:
            if len(self.heap) < self.size:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)

    @staticmethod
    def of(entries, size: int) -> Best:
        best = Best(size)
        best.heap = heapq.nlargest(size, entries)
        heapq.heapify(best.heap)
        return best

    def pairs(self) -> list[tuple[int, int]]:
        return [(score, -negated) for score, negated in sorted(self.heap, reverse=True)]


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """The scores s with low * positive <= 100 * s <= high * positive, from and to."""
    return -(-low * positive // 100), high * positive // 100


def _matrix(rows: pa.Table) -> np.ndarray:
    flat = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(rows), -1)


def _scores(anchors: np.ndarray, candidates: np.ndarray, cutoff: int):
    """(anchor, its scores with all candidates), a tile at a time."""
    left, right = whole_numbers(anchors, candidates)
    for start in range(0, len(left), ANCHORS_AT_ONCE):
        # a transposed view: rows and columns that meet are contiguous, which int64 products need
        tile = strassen(left[start : start + ANCHORS_AT_ONCE], right.T, cutoff)
        for row, scores in enumerate(tile):
            yield start + row, scores


_FOUND = "anchor_id LONG, variant LONG, label LONG, place INT, positive_id LONG, positive_score LONG, found_id LONG, score LONG"
_ANCHOR = ["anchor_id", "variant", "label"]


def _as_table(rows: list[tuple]) -> pa.Table:
    names = [column.split()[0] for column in _FOUND.split(", ")]
    types = [pa.int32() if name == "place" else pa.int64() for name in names]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table({name: pa.array(values, kind) for name, values, kind in zip(names, columns, types)})


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = 50,
    high: int = 95,
    anchor_block: int = ANCHOR_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
    cutoff: int = CUTOFF,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` are (vec_id, label, vector), vectors of whole numbers as doubles. An anchor's
    positives are its first ``positives`` other rows of the same label, its negatives for one of
    them the first ``negatives`` rows of other labels with low * positive_score <= 100 * score
    <= high * positive_score: higher inner products first, ties to the smaller id. Fewer are given
    where there are fewer, none for a positive without a row in its window.

    Rows without vec_id, label or vector take no part, nor do vectors of another length than the
    anchor's. Other rows are those with another vec_id. Rows that repeat a vec_id are candidates
    of their own, and anchors of their own unless all three columns agree. A score beyond 64 bits
    fails.
    """
    ship_package(rows.sparkSession)
    # numbered in the written table, so that equal rows spread over blocks and stay where they are
    kept = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "vector",
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"), F.monotonically_increasing_id().alias("number"),
    ).where("vec_id is not null and label is not null and vector is not null")
    kept = written(kept.withColumn("size", F.size("vector")), "vectors")
    anchors = kept.where("is_anchor").select(
        F.col("vec_id").alias("anchor_id"), F.xxhash64("vector").alias("variant"), "label", "size", "vector"
    )
    anchors = written(anchors.distinct(), "anchors")
    n_left = max(1, -(-anchors.count() // anchor_block))
    n_right = max(1, -(-kept.count() // candidate_block))

    def copies(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    left = F.pmod(F.xxhash64("anchor_id", "variant"), F.lit(n_left)).cast("int").alias("left")
    right = F.pmod(F.xxhash64("number"), F.lit(n_right)).cast("int").alias("right")
    candidates = kept.select("size", "vec_id", "label", "vector", right, copies(n_left, "left"))
    keys = ["size", "left", "right"]

    def of_tile(asked: DataFrame, search) -> DataFrame:
        dealt = asked.select("*", left, copies(n_right, "right"))
        return dealt.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(search, _FOUND)

    def first_of(found: DataFrame, by: list[str], size: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "found_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)

    def search_positives(asked: pa.Table, given: pa.Table) -> pa.Table:
        found = []
        if len(asked) and len(given):
            ids, labels = given.column("vec_id").to_numpy(), given.column("label").to_numpy()
            named = list(zip(*(asked.column(c).to_pylist() for c in _ANCHOR)))
            for at, scores in _scores(_matrix(asked), _matrix(given), cutoff):
                anchor_id, _, label = named[at]
                best, same = Best(positives), np.flatnonzero((labels == label) & (ids != anchor_id))
                best.offer(scores[same], ids[same])
                found += [(*named[at], 0, None, None, i, score) for score, i in best.pairs()]
        return _as_table(found)

    found = first_of(of_tile(anchors, search_positives), _ANCHOR, positives)
    targets = found.groupBy(*_ANCHOR).agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank").alias("place"), F.col("found_id").alias("id"), "score"))).alias("targets")
    )
    asked = written(anchors.join(targets, _ANCHOR), "targets")

    def search_windows(asked: pa.Table, given: pa.Table) -> pa.Table:
        found = []
        if len(asked) and len(given):
            ids, labels = given.column("vec_id").to_numpy(), given.column("label").to_numpy()
            named = list(zip(*(asked.column(c).to_pylist() for c in _ANCHOR)))
            wanted = asked.column("targets").to_pylist()
            for at, scores in _scores(_matrix(asked), _matrix(given), cutoff):
                other = np.flatnonzero((labels != named[at][2]) & (ids != named[at][0]))
                scores, own = scores[other], ids[other]
                for target in wanted[at]:
                    least, most = window(target["score"], low, high)
                    inside = np.flatnonzero((scores >= least) & (scores <= most))
                    best = Best(negatives)
                    best.offer(scores[inside], own[inside])
                    place = (target["place"], target["id"], target["score"])
                    found += [(*named[at], *place, i, score) for score, i in best.pairs()]
        return _as_table(found)

    mined = first_of(of_tile(asked, search_windows), [*_ANCHOR, "place"], negatives)
    return mined.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def labelled(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, vector): floor(scale * x) of every component x as double, every seventh
    label moved on by one. Rows without vec_id, label or vector and those with a null or
    non-finite component are left out."""
    ship_package(embeddings.sparkSession)
    doubles = F.col("embedding").cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = embeddings.where("vec_id is not null and label is not null").where(F.coalesce(finite, F.lit(False)))
    return whole.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.transform(doubles, lambda x: F.floor(x * scale).cast("double")).alias("vector"),
    )
