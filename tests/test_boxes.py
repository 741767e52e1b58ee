"""Nearest vectors by boxed blocks against a comparison of all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import boxes as B
from riskframe.operators import neighbors as N


def brute(rows, k):
    out = {}
    for i, g, v in rows:
        near = sorted((sum((a - b) ** 2 for a, b in zip(v, u)), j) for j, h, u in rows if h == g and j != i)
        out[i] = [(j, round(d, 9)) for d, j in near[:k]]
    return out


def found(spark, rows, k, want=None, **kw):
    df = spark.createDataFrame(rows, "i long, g long, vec array<double>").repartition(3)
    got = {}
    for r in B.near_pairs(df, k, ["g"], len(rows[0][2]), want, **kw).collect():
        got.setdefault(r.i, []).append((round(r.square, 9), r.nn_i))
    return {i: [(j, d) for d, j in sorted(v)[:k]] for i, v in got.items()}


@pytest.mark.parametrize("block_rows", [4, 16, 2048])
def test_every_vector_gets_its_nearest(spark, block_rows):
    rng = np.random.default_rng(4)
    rows = [(i, i % 3 // 2, [float(rng.integers(0, 4)), float(rng.normal()), float(rng.integers(0, 3))]) for i in range(400)]
    rows += [(1000 + i, 0, [50.0 + 30.0 * i, -9.0, 1e4]) for i in range(3)]       # far from everything
    rows += [(2000 + i, 7, [float(i), 0.0, 0.0]) for i in range(3)]               # a group of fewer than k others
    want = brute(rows, 5)
    assert found(spark, rows, 5, block_rows=block_rows) == want
    some = found(spark, rows, 5, F.col("i") % 10 == 0, block_rows=block_rows)
    assert some == {i: v for i, v in want.items() if i % 10 == 0}


def test_few_blocks_are_met(spark, monkeypatch):
    """In few dimensions a query travels to a handful of blocks, whatever their number."""
    rng = np.random.default_rng(5)
    rows = [(i, 0, rng.random(3).tolist()) for i in range(6000)]
    df = spark.createDataFrame(rows, "i long, g long, vec array<double>")
    tree = B.grow_tree(np.array([r[2] for r in rows]), 64)
    leaf = B.leaf_of(np.array([r[2] for r in rows]), tree)
    assert leaf.max() >= 93 and np.bincount(leaf).max() <= 64
    pairs = B.near_pairs(df, 5, ["g"], 3, block_rows=64)
    assert pairs.count() < 6000 * 20       # candidates of all blocks met
    same = B.grow_tree(np.ones((50, 2)), 4)
    assert B.leaf_of(np.ones((50, 2)), same).tolist() == [0] * 50


def test_knn_of_string_keys_nulls_and_ties(spark):
    rows = [(f"k{i:02}", [float(i % 4), float(i // 4)]) for i in range(20)] + [("n", None), ("m", [None, 1.0])]
    got = {}
    for r in N.knn(spark.createDataFrame(rows, "k string, v array<double>"), "k", "v", k=3).collect():
        got.setdefault(r.k, []).append((r["rank"], r.nn_key, r.dist))
    assert sorted(got["k05"]) == [(1, "k01", 1.0), (2, "k04", 1.0), (3, "k06", 1.0)]
    assert set(got) == {r[0] for r in rows[:20]}
