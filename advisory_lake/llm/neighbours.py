"""Approximate nearest neighbours by Euclidean distance, with adaptive scans of probed lists.

Lists are those of a k-means fitted on a bounded sample; every row is put into the list of its
nearest centre. Lists are dealt into shards of bounded size, a large list into several, small
ones together. Rows keep their vectors turned by one random rotation, in blocks of columns.

A query probes the lists nearest to it, as many as the sample needed for ``RECALL``. In a list it
adds up squared differences a block of columns at a time. After m of d turned columns, the partial
distance p estimates the distance by p * sqrt(d / m); where this exceeds the k-th distance so far
by more than the error that a random rotation makes, the candidate is abandoned. What is left at
the last column is measured on the original vectors. Queries first scan the shard of their nearest
list, and go to the others with the k-th distance found there.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from advisory_lake.llm.shared import ship_package, written

TRAIN_ROWS, TRAIN_BYTES = 16_384, 16 << 20  # of each vector length, drawn by a hash: what centres and probes are fitted on
TRAIN_QUERIES = 256
MOST_LISTS = 4_096
ROUNDS = 10
RECALL = 0.97  # share of a sample's neighbours that the probed lists hold
BLOCK_COLUMNS = 16
DOUBT = 2.1  # width of the test: a true neighbour is abandoned in well under a hundredth of cases
SHARD_BYTES, BLOCK_QUERIES = 16 << 20, 4_096  # what meets in one task
AT_ONCE = 512  # vectors compared with all centres
SALTS = 1 << 20


@dataclass
class Index:
    """What tasks need to know about vectors of one length; its size does not follow the rows."""

    centres: np.ndarray
    rotation: np.ndarray
    probes: int

    def own_lists(self, vectors: np.ndarray) -> np.ndarray:
        """The nearest list of each vector."""
        parts = [_squares(vectors[i : i + AT_ONCE], self.centres).argmin(axis=1) for i in range(0, len(vectors), AT_ONCE)]
        return np.concatenate(parts)

    def nearest_lists(self, vectors: np.ndarray):
        """For each vector all lists, nearest first."""
        for start in range(0, len(vectors), AT_ONCE):
            yield from _squares(vectors[start : start + AT_ONCE], self.centres).argsort(axis=1, kind="stable")


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to each other, up to rounding."""
    return (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * (a @ b.T)


def centres_of(sample: np.ndarray, lists: int, seed: int) -> np.ndarray:
    """Lloyd's k-means; a centre without rows stays where it is."""
    different = np.unique(sample, axis=0)
    rng = np.random.default_rng(seed)
    centres = different[rng.choice(len(different), min(lists, len(different)), replace=False)]
    for _ in range(ROUNDS):
        own = Index(centres, np.empty(0), 0).own_lists(sample)
        order = np.argsort(own, kind="stable")
        found, starts = np.unique(own[order], return_index=True)
        sums = np.add.reduceat(sample[order], starts, axis=0)
        centres = centres.copy()
        centres[found] = sums / np.bincount(own, minlength=len(centres))[found, None]
    return centres


def fitted(sample: np.ndarray, rows: int, k: int, seed: int = 5) -> Index:
    """Centres, a rotation, and how many lists a query must probe: the fewest that hold ``RECALL``
    of the neighbours that sampled queries have within the sample."""
    # numbers of any size: distances are compared, so a common factor does not matter
    scale = np.abs(sample).max() or 1.0
    lists = max(1, min(MOST_LISTS, round(rows**0.5 / 4), len(sample)))
    centres = centres_of(sample / scale, lists, seed) * scale
    rng = np.random.default_rng(seed)
    rotation, upper = np.linalg.qr(rng.standard_normal((sample.shape[1],) * 2))
    index = Index(centres, rotation * np.sign(np.diag(upper)), len(centres))
    asked = sample[rng.choice(len(sample), min(TRAIN_QUERIES, len(sample)), replace=False)] / scale
    apart = _squares(asked, sample / scale)
    near = np.argsort(apart, axis=1, kind="stable")[:, 1 : k + 1]  # the first is the query itself
    if near.size:
        own = _squares(sample / scale, centres / scale).argmin(axis=1)
        order = _squares(asked, centres / scale).argsort(axis=1, kind="stable")
        place = np.argsort(order, axis=1)  # of each list in the query's order
        index.probes = int(np.quantile(np.take_along_axis(place, own[near], axis=1), RECALL, method="higher")) + 1
    return index


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of rows with both, no null or non-finite component, not all zero."""
    ship_package(embeddings.sparkSession)
    doubles = F.col("embedding").cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(doubles, lambda x: x != 0)
    kept = embeddings.where("vec_id is not null").where(F.coalesce(finite & some, F.lit(False)))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("vector"))


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _by_size(batch: pa.RecordBatch):
    """(vector length, rows of that length)."""
    sizes = batch.column("size").to_numpy()
    for size in np.unique(sizes):
        yield int(size), batch.filter(pa.array(sizes == size))


def put_into_lists(vectors: DataFrame, indexes: dict[int, Index]) -> DataFrame:
    """Every row with its list, its vector turned and cut into blocks of columns, and a salt."""

    def run(batches):
        seen = 0
        for batch in batches:
            for size, part in _by_size(batch):
                index, given = indexes[size], _matrix(part.column("vector"), size)
                own, turned = index.own_lists(given), given @ index.rotation
                salts = (seen + np.arange(len(part))) * 7919 % SALTS  # neighbours in a batch go apart
                seen += len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id"), part.column("size"), part.column("vector"),
                        pa.array(own.astype(np.int32)), pa.array(salts.astype(np.int32)),
                        pa.ListArray.from_arrays(np.arange(0, len(part) * size + 1, size, dtype=np.int32), turned.reshape(-1)),
                    ],
                    names=["vec_id", "size", "vector", "list", "salt", "turned"],
                )

    schema = "vec_id LONG, size INT, vector ARRAY<DOUBLE>, list INT, salt INT, turned ARRAY<DOUBLE>"
    return vectors.mapInArrow(run, schema)


def shards_of(sizes: dict[int, int], shard_rows: int) -> dict[int, tuple[int, int]]:
    """(first shard, number of shards) of each list: small lists share one, large ones have several."""
    placed, shard, held = {}, 0, 0
    for name, rows in sorted(sizes.items()):
        if held and held + rows > shard_rows:
            shard, held = shard + 1, 0
        several = -(-rows // shard_rows)
        placed[name] = (shard, several)
        held += rows
        if several > 1:
            shard, held = shard + several, 0
    return placed


class Nearest:
    """The first ``size`` (squared distance, id) pairs; ``bound`` is beyond what still counts."""

    def __init__(self, size: int, bound: float):
        self.size, self.start, self.heap = size, bound, []

    @property
    def bound(self) -> float:
        return min(self.start, -self.heap[0][0]) if len(self.heap) == self.size else self.start

    def offer(self, squares: np.ndarray, ids: np.ndarray) -> None:
        for square, name in zip(squares.tolist(), ids.tolist()):
            entry = (-square, -name)
            if len(self.heap) < self.size:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)


def scan(query: np.ndarray, turned: np.ndarray, name: int, nearest: Nearest, blocks: list[np.ndarray], vectors: np.ndarray, ids: np.ndarray) -> int:
    """Look through one list; ``blocks`` are its turned columns, block after block. Gives the
    number of columns that were added up."""
    alive = np.flatnonzero(ids != name)
    partial, done, work = np.zeros(len(alive)), 0, 0
    size, rounding = len(query), 1e-12 * (query**2).sum()
    for block in blocks:
        width = len(block)
        own = block[:, alive] if len(alive) < block.shape[1] else block
        partial = partial + ((own - turned[done : done + width, None]) ** 2).sum(axis=0)
        done += width
        work += width * len(alive)
        limit = nearest.bound * (done / size) * ((1 + DOUBT / np.sqrt(done)) ** 2 if done < size else 1 + 1e-9)
        stay = partial <= limit + rounding
        if not stay.all():
            alive, partial = alive[stay], partial[stay]
        if not len(alive):
            return work
    if len(alive) > nearest.size:
        # the turned distances choose, with room for rounding
        kth = np.partition(partial, nearest.size - 1)[nearest.size - 1]
        alive = alive[partial <= kth * (1 + 1e-9) + rounding]
    squares = ((vectors[alive] - query) ** 2).sum(axis=1)
    by = np.lexsort((ids[alive], squares))[: nearest.size]
    nearest.offer(squares[by], ids[alive][by])
    return work


_HITS = "query LONG, query_id LONG, vec_id LONG, square DOUBLE"


def nearest(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows of ``vectors`` (vec_id, vector) that are
    queries the ``k`` nearest rows found by Euclidean distance, all if there are fewer.

    Scores are distances of the original vectors in doubles; ties go to the smaller vec_id. A
    query does not find rows with its own vec_id. Rows that repeat a vec_id are candidates of
    their own, and queries of their own unless their vectors agree as well. Only vectors as long
    as the query take part. A query whose probed lists hold fewer than 4 * k rows probes on.
    """
    ship_package(vectors.sparkSession)
    sized = vectors.where("vec_id is not null and vector is not null").withColumn("size", F.size("vector"))
    sized = written(sized.where("size > 0").withColumn("is_query", F.coalesce(is_query, F.lit(False))), "vectors")
    counts = {row["size"]: row.n for row in sized.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return sized.sparkSession.createDataFrame([], "query_id LONG, rank INT, vec_id LONG, score DOUBLE")
    indexes = {}
    for size, rows in sorted(counts.items()):
        own = sized.where(F.col("size") == size)
        drawn = own.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").select("vector")
        drawn = drawn.limit(max(1, min(TRAIN_ROWS, TRAIN_BYTES // (8 * size))))
        indexes[size] = fitted(_matrix(drawn.toArrow().column("vector"), size), rows, k)

    listed = written(put_into_lists(sized.select("vec_id", "size", "vector"), indexes), "lists")
    sizes: dict[int, dict[int, int]] = {}
    for row in listed.groupBy("size", "list").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes.setdefault(row["size"], {})[row["list"]] = row.n
    places = {size: shards_of(own, max(256, SHARD_BYTES // (16 * size))) for size, own in sizes.items()}

    def deal_rows(batches):
        for batch in batches:
            for size, part in _by_size(batch):
                first, several = (np.zeros(len(indexes[size].centres), np.int64) for _ in range(2))
                for name, place in places[size].items():
                    first[name], several[name] = place
                own = part.column("list").to_numpy()
                shard = first[own] + part.column("salt").to_numpy() % several[own]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shard.astype(np.int32))], names=[*part.schema.names, "shard"])

    def deal_queries(batches):
        for batch in batches:
            for size, part in _by_size(batch):
                rows, shards, probes, first = [], [], [], []
                for i, lists in enumerate(indexes[size].nearest_lists(_matrix(part.column("vector"), size))):
                    wanted: dict[int, list[int]] = {}
                    held = 0
                    for n, name in enumerate(lists.tolist()):
                        if n >= indexes[size].probes and held >= 4 * k:
                            break
                        held += sizes[size].get(name, 0)
                        start, several = places[size].get(name, (0, 0))
                        for shard in range(start, start + several):
                            wanted.setdefault(shard, []).append(name)
                    for n, (shard, names) in enumerate(wanted.items()):
                        rows.append(i)
                        shards.append(shard)
                        probes.append(names)
                        first.append(n == 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(pa.array(rows, pa.int64())) for c in ("vec_id", "size", "vector", "query", "block")),
                        pa.array(shards, pa.int32()), pa.array(probes, pa.list_(pa.int32())), pa.array(first, pa.bool_()),
                    ],
                    names=["vec_id", "size", "vector", "query", "block", "shard", "probes", "first"],
                )

    n_blocks = max(1, -(-sized.where("is_query").count() // BLOCK_QUERIES))
    asked = sized.where("is_query").select(
        "vec_id", "size", "vector", F.xxhash64("vec_id", "vector").alias("query"),
    ).distinct().withColumn("block", F.pmod(F.col("query"), F.lit(n_blocks)).cast("int"))
    asked = asked.mapInArrow(
        deal_queries,
        "vec_id LONG, size INT, vector ARRAY<DOUBLE>, query LONG, block INT, shard INT, probes ARRAY<INT>, first BOOLEAN",
    )
    asked = written(asked, "queries")
    rows = listed.mapInArrow(
        deal_rows,
        "vec_id LONG, size INT, vector ARRAY<DOUBLE>, list INT, salt INT, turned ARRAY<DOUBLE>, shard INT",
    ).drop("salt")
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    rows = rows.select("*", blocks)

    def of_shard(asks: pa.Table, given: pa.Table) -> pa.Table:
        hits: list[tuple] = []
        if len(asks) and len(given):
            size = asks.column("size")[0].as_py()
            order = np.argsort(given.column("list").to_numpy(), kind="stable")
            lists = given.column("list").to_numpy()[order]
            ids = given.column("vec_id").to_numpy()[order]
            own = _matrix(given.column("vector"), size)[order]
            turned = _matrix(given.column("turned"), size)[order].T
            blocks = [np.ascontiguousarray(turned[at : at + BLOCK_COLUMNS]) for at in range(0, size, BLOCK_COLUMNS)]
            starts = dict(zip(*np.unique(lists, return_index=True)))
            ends = dict(zip(*(x[::-1] for x in np.unique(lists[::-1], return_index=True))))
            queries = _matrix(asks.column("vector"), size)
            turned_queries = queries @ indexes[size].rotation
            names, keys = asks.column("vec_id").to_pylist(), asks.column("query").to_pylist()
            bounds, probes = asks.column("bound").to_pylist(), asks.column("probes").to_pylist()
            for i, name in enumerate(names):
                best = Nearest(k, np.inf if bounds[i] is None else bounds[i])
                for probe in probes[i]:
                    if probe not in starts:
                        continue
                    a, b = starts[probe], len(lists) - ends[probe]
                    scan(queries[i], turned_queries[i], name, best, [block[:, a:b] for block in blocks], own[a:b], ids[a:b])
                hits += [(keys[i], name, -negated, -square) for square, negated in best.heap]
        columns = list(zip(*hits)) if hits else [()] * 4
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table({c: pa.array(v, t) for c, v, t in zip(("query", "query_id", "vec_id", "square"), columns, types)})

    keys = ["size", "shard", "block"]

    def searched(asks: DataFrame) -> DataFrame:
        return asks.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(of_shard, _HITS)

    begun = written(searched(asked.where("first").withColumn("bound", F.lit(None).cast("double"))), "hits")
    full = begun.groupBy("query", "query_id").agg(F.count(F.lit(1)).alias("n"), F.max("square").alias("bound"))
    full = full.where(F.col("n") >= k).select("query", F.col("query_id").alias("vec_id"), "bound")
    hits = begun.unionByName(searched(asked.where("not first").join(full, ["query", "vec_id"], "left")))
    order = Window.partitionBy("query", "query_id").orderBy("square", "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.sqrt("square").alias("score"))
