"""Hard negatives against a comparison of all pairs."""

import math

import numpy as np
import pytest

from riskframe.llm import hard_negatives as H


def brute(rows, scale=256, k=5, negatives=5, low=80, high=100, every=10):
    kept = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept[i] = min(kept.get(i, (label, v)), (label, v))
    q = {i: (label, [math.floor(scale * x) for x in v]) for i, (label, v) in kept.items()}
    out = []
    for a in (i for i in q if i % every == 0):
        score = {i: sum(x * y for x, y in zip(q[a][1], v)) for i, (_, v) in q.items() if i != a}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if q[i][0] == q[a][0]][:k]:
            far = [i for i in ranked if q[i][0] != q[a][0] and low * score[p] <= 100 * score[i] <= high * score[p]][:negatives]
            out += [(a, p, r, n, score[p], score[n]) for r, n in enumerate(far, 1)]
    return sorted(out)


def mined(spark, rows, parts=4, **options):
    df = spark.createDataFrame([(i, l, v, 1, "x", "y") for i, l, v in rows], "vid long, lab int, v array<double>, id long, key string, score string").repartition(parts)
    got = H.mine_hard_negatives(df, "vid", "lab", "v", lambda i: i % 10 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def clustered(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    return [(i, int(rng.integers(0, 4)), (centres[i % 4] + 0.3 * rng.normal(size=dims)).tolist()) for i in range(n)]


@pytest.mark.parametrize("block_rows", [16, 8192])
def test_against_all_pairs(spark, block_rows):
    rows = clustered(400, 21, 1)
    rows += [(1000 + i, i % 3, rows[7][2]) for i in range(80)]                         # copies under several labels
    rows += [(2000, None, [1.0] * 21), (2010, 1, None), (2020, 1, [None] + [1.0] * 20), (2030, 2, [float("nan")] * 21), (2040, 2, [float("inf")] * 21),
             (None, 1, [1.0] * 21), (2050, 1, []), (2060, 2, [0.5]), (2070, 3, [0.0] * 21), (2080, 3, [0.25] * 30), (50, 0, [9.0] * 21), (50, 3, [0.0] * 21)]
    expected = brute(rows)
    assert len(expected) > 500 and mined(spark, rows, block_rows=block_rows) == expected


def test_ties_and_few_rows(spark):
    rows = [(i, i % 2, [1.0, 0.0]) for i in range(0, 30)]
    assert mined(spark, rows) == brute(rows)
    rows = [(0, 1, [1.0]), (1, 1, [2.0]), (2, 2, [1.9]), (3, 2, [2.0]), (4, 2, [1.0]), (10, 5, [1.0]), (20, 1, [-1.0])]
    assert mined(spark, rows) == brute(rows) and mined(spark, rows, low=50, high=90, negatives=1) == brute(rows, low=50, high=90, negatives=1)


def test_large_components(spark):
    rows = [(i, i % 3, [(-1) ** i * 2.0 ** 20 + i, 3.0 * i, 2.0 ** 19]) for i in range(60)]
    assert mined(spark, rows) == brute(rows)
    with pytest.raises(Exception, match="62 bits"):
        mined(spark, [(i, i % 2, [1e12, 1e12]) for i in range(20)])


def test_empty(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []


def test_pruning_reads_less():
    """A block out of reach isn't read, and candidates leave before the end."""
    row = {"n": 3, "dims": 2, "kind": "<i2", "ids": np.array([1, 2, 3], "<i8").tobytes(), "labels": np.zeros(3, "<i8").tobytes(),
           "columns": np.array([[9, 1, 5], [0, 1, 9]], "<i2").tobytes()}
    block = H._Block(row)
    assert block.lo.tolist() == [1, 0] and block.hi.tolist() == [9, 9]
    s = H._Search.__new__(H._Search)
    s.id, s.label, s.vec, s.key = np.array([7]), np.array([0]), np.array([[10, -1]]), np.array([[0]])
    s.k, s.same, s.lo, s.hi = 1, True, np.array([[91]]), np.array([[H._MOST]])
    s.score, s.found = np.full((1, 1, 1), H._LEAST), np.full((1, 1, 1), H._MOST)
    s.scan(block)
    assert s.score[0, 0, 0] == H._LEAST  # 90 at most
    s.lo[:] = 41
    s.scan(block)
    assert (s.score[0, 0, 0], s.found[0, 0, 0], s.lo[0, 0]) == (90, 1, 90)


def test_other_numbers_of_rows(spark):
    rows = [(i, l, [float(np.float32(x)) for x in v]) for i, l, v in clustered(300, 8, 4)]
    assert mined(spark, rows, scale=64.0, positives=2, negatives=3) == brute(rows, scale=64, k=2, negatives=3)
