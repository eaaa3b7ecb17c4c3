"""Nearest neighbours: recall against all pairs, exact scores, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from advisory_lake.llm import neighbours, queries

SCHEMA = "vec_id LONG, embedding ARRAY<DOUBLE>, label INT, list STRING, size STRING, score STRING"


def recall(spark, tables_dir, found):
    rows = spark.read.parquet(f"{tables_dir}/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    hits = wanted = 0
    assert set(by_query) == {i for i in ids.tolist() if i % 100 == 0}
    for query, own in by_query.items():
        apart = np.sqrt(((vectors - vectors[ids == query]) ** 2).sum(axis=1))
        apart[ids == query] = np.inf
        first = ids[np.lexsort((ids, apart))[:10]]
        own.sort()
        assert [rank for rank, _, _ in own] == list(range(1, 11))
        assert [(s, i) for _, s, i in own] == sorted((s, i) for _, s, i in own) and query not in [i for *_, i in own]
        assert all(abs(apart[ids == i][0] - score) < 1e-12 for _, score, i in own)
        hits, wanted = hits + len(set(first.tolist()) & {i for *_, i in own}), wanted + 10
    return hits / wanted


@pytest.mark.parametrize("scale", ["0.01", "0.1"])
def test_recall_of_the_query(spark, scale):
    tables_dir = f"/root/testdata/sf{scale}"
    assert recall(spark, tables_dir, queries.op13_nearest_neighbours(spark, tables_dir).collect()) >= 0.93


def test_recall_with_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_BYTES", 1)  # 256 rows each
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 6)
    tables_dir = "/root/testdata/sf0.1"
    assert recall(spark, tables_dir, queries.op13_nearest_neighbours(spark, tables_dir).collect()) >= 0.93


def test_large_lists_have_shards_of_their_own():
    placed = neighbours.shards_of({0: 10, 1: 20, 2: 900, 3: 5, 4: 100}, 100)
    assert placed == {0: (0, 1), 1: (0, 1), 2: (1, 9), 3: (10, 1), 4: (11, 1)}


def test_clustered_vectors_need_few_lists_and_little_work():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 64)) * 10
    sample = centres[rng.integers(0, 40, 6400)] + rng.standard_normal((6400, 64))
    index = neighbours.fitted(sample, 6400, 10)
    assert index.probes <= len(index.centres) // 4
    turned = (sample @ index.rotation).T
    blocks = [np.ascontiguousarray(turned[k : k + 16]) for k in range(0, 64, 16)]
    ids = np.arange(len(sample))
    best = neighbours.Nearest(10, np.inf)
    neighbours.scan(sample[0], turned[:, 0], 0, best, blocks, sample, ids)
    again = neighbours.Nearest(10, best.bound)
    work = neighbours.scan(sample[0], turned[:, 0], 0, again, blocks, sample, ids)
    assert work < 0.4 * 64 * len(sample)  # most candidates are abandoned after a block
    assert sorted(again.heap)[1:] == sorted(best.heap)[1:]


def found_of(df, k=10):
    rows = neighbours.nearest(neighbours.usable(df), F.expr("vec_id % 100 = 0"), k).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (100, [0.0, 3.0]), (200, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]),
            (3, [4.0, 4.0]), (None, [1.0, 1.0]), (300, None), (400, []), (500, [0.0, 0.0]), (600, [1.0, None]), (700, [float("nan"), 1.0]),
            (800, [float("inf"), 1.0]), (900, [1.0, 2.0, 3.0]), (901, [1.0, 2.0, 4.0]), (1000, [5.0])]
    df = spark.createDataFrame([(i, v, 1, "l", "s", "x") for i, v in rows], SCHEMA)
    kept = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    want = []
    for query, vector in {(i, tuple(v)) for i, v in kept if i % 100 == 0}:
        apart = sorted((float(np.sqrt(((np.array(v) - vector) ** 2).sum())), i) for i, v in kept if i != query and len(v) == len(vector))
        want += [(query, rank + 1, i, score) for rank, (score, i) in enumerate(apart[:10])]
    assert found_of(df) == sorted(want)
    assert found_of(df.limit(0)) == [] and found_of(df.where("vec_id = 500")) == []


def test_a_third_of_equal_vectors(spark, monkeypatch):
    """Ties go to the smaller id, however many rows tie and however many shards hold them."""
    monkeypatch.setattr(neighbours, "SHARD_BYTES", 1)
    rng = np.random.default_rng(9)
    hot = rng.standard_normal(8)
    rows = [(i, (hot if i % 3 == 0 else rng.standard_normal(8)).tolist(), 1, "l", "s", "x") for i in range(3000)]
    found = found_of(spark.createDataFrame(rows, SCHEMA))
    for query in range(0, 3000, 300):
        want = [i for i in range(0, 40, 3) if i != query][:10]
        assert [(r[1], r[2], r[3]) for r in found if r[0] == query] == [(k + 1, i, 0.0) for k, i in enumerate(want)]
