"""Hard negatives against SQL, in many small blocks, and the product they rest on."""

import numpy as np
import pytest
from harness import duck, duck_rows, spark_rows
from pyspark.sql import functions as F

from advisory_lake.llm import negatives, sql

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, score STRING, rank STRING, variant STRING"


@pytest.mark.parametrize("cutoff", [1, 2, 8, 64])
def test_products_of_any_sides(cutoff):
    rng = np.random.default_rng(cutoff)
    for rows, inner, columns in [(1, 1, 1), (3, 7, 5), (16, 16, 16), (33, 20, 65), (40, 129, 31), (0, 4, 4)]:
        a, b = (rng.integers(-(2**62), 2**62, side) for side in ((rows, inner), (inner, columns)))
        assert (negatives.strassen(a, b, cutoff) == a @ b).all()  # both modulo 2**64


def test_numbers_beyond_64_bits_stay_exact():
    a, b = np.array([[2.0**70, 3.0]]), np.array([[1.0, 2.0**63], [-(2.0**70), 1.0]])
    left, right = negatives.whole_numbers(a, b)
    assert negatives.strassen(left, right.T, 1).tolist() == [[2**70 + 3 * 2**63, 3 - 2**140]]
    assert negatives.whole_numbers(a * 0, b * 0)[0].dtype == np.int64


def test_heaps_merge_and_keep_ties_apart():
    rng = np.random.default_rng(1)
    scores, ids = rng.integers(0, 5, 400), rng.permutation(400)
    best = negatives.Best(7)
    for part in np.array_split(np.arange(400), 9):
        other = negatives.Best(7)
        other.offer(scores[part], ids[part])
        best.merge(other)
    assert best.pairs() == sorted(zip(scores.tolist(), ids.tolist()), key=lambda p: (-p[0], p[1]))[:7]


def test_windows_are_those_of_whole_numbers():
    for positive in (-101, -7, -1, 0, 1, 7, 19, 100, 10**17):
        low, high = negatives.window(positive, 50, 95)
        assert [50 * positive <= 100 * s <= 95 * positive for s in (low - 1, low, high, high + 1)] == [False, low <= high, low <= high, False]


@pytest.mark.parametrize("blocks", [(3, 41, 4), (1000, 1000, 32)])
def test_blocks_do_not_change_the_result(spark, blocks):
    tables_dir = "/root/testdata/sf0.01"
    anchor_block, candidate_block, cutoff = blocks
    rows = negatives.labelled(spark.read.parquet(f"{tables_dir}/embeddings.parquet"))
    found = negatives.hard_negatives(
        rows, F.expr("vec_id % 50 = 0"), anchor_block=anchor_block, candidate_block=candidate_block, cutoff=cutoff
    )
    assert spark_rows(found) == duck_rows(duck(tables_dir), sql.OP12)


def plain(rows):
    """The contract in loops: rows are (vec_id, vector, label)."""
    kept = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(256.0 * np.float32(x).astype(float))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    found = []
    for i, v, label in {(i, tuple(v), label) for i, v, label in kept if i % 50 == 0}:
        scored = [(sum(x * y for x, y in zip(v, w)), j, other) for j, w, other in kept if j != i and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p, j, _ in [s for s in scored if s[2] == label][:5]:
            inside = [(s, k) for s, k, other in scored if other != label and 50 * p <= 100 * s <= 95 * p][:3]
            found += [(i, j, rank + 1, k, p, s) for rank, (s, k) in enumerate(inside)]
    return sorted(found)


def test_odd_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in rng.integers(0, 3, 3)], int(rng.integers(0, 3))) for i in range(101)]
    rows += [(50, [1.0, 2.0, 1.0], 1), (50, [1.0, 2.0, 1.0], 1), (51, [1.0, 2.0, 1.0], 1), (51, [1.0, 2.0, 1.0], 1)]
    rows += [(None, [1.0, 1.0, 1.0], 1), (100, None, 1), (150, [1.0, None, 1.0], 1), (200, [1.0, float("nan"), 1.0], 1),
             (250, [float("inf"), 1.0, 1.0], 1), (300, [1.0, 1.0, 1.0], None), (350, [1.0, 1.0], 1), (400, [1.0, 2.0], 1),
             (1001, [1.0, 1.0], 2), (450, [], 1), (500, [0.0, 0.0, 0.0], 1), (550, [-1.0, 0.0, 0.0], 2)]
    df = spark.createDataFrame([(*r, "s", "r", "v") for r in rows], SCHEMA)

    def mined(df, **blocks):
        found = negatives.hard_negatives(negatives.labelled(df), F.expr("vec_id % 50 = 0"), **blocks)
        return sorted(map(tuple, found.collect()))

    assert mined(df) == mined(df, anchor_block=2, candidate_block=9) == plain(rows) != []
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id = 50")) == []
