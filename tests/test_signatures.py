"""Signature lists against all pairs."""

import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from riskframe.operators import signatures as S


def brute(rows, asked, k):
    out = {}
    for g, key, v in rows:
        if asked(key):
            near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, u))), other) for h, other, u in rows if h == g and other != key)
            out[key] = [(i + 1, other, round(d, 9)) for i, (d, other) in enumerate(near[:k])]
    return out


def fixture():
    rnd = random.Random(4)
    rows = [("a" if i % 3 else "b", i, [rnd.gauss(i % 5, 1) for _ in range(6)]) for i in range(300)]
    rows += [("a", 1000 + i, rows[10][2]) for i in range(50)]            # a group of copies
    return rows + [("c", 2000, [0.0] * 6), ("c", 2010, [1.0] * 6)] + [("d", 3000 + i, [float(i % 3)] * 6) for i in range(40)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "grp string, k long, v array<double>").repartition(4)


def test_exact_search_of_chosen_rows(spark):
    rows = fixture()
    nn, probing = S.knn_of(frame(spark, rows), "k", "v", F.col("k") % 10 == 0, k=4, group_cols=["grp"])
    got = {}
    for r in nn.collect():
        got.setdefault(r["k"], []).append((r["rank"], r["nn_key"], round(r["dist"], 9)))
    want = {k: v for k, v in brute(rows, lambda k: k % 10 == 0, 4).items() if v}
    assert {k: sorted(v) for k, v in got.items()} == want and probing.bits == 0


def test_signature_lists_reach_their_recall(spark):
    rows = fixture()
    df = frame(spark, rows)
    exact, _ = S.knn_of(df, "k", "v", F.lit(True), k=4, group_cols=["grp"])
    found, probing = S.knn_of(df, "k", "v", F.lit(True), k=4, group_cols=["grp"], recall=0.95, list_rows=8)
    r = S.recall_report(exact, found, "k").first()
    assert probing.bits >= 3 and len(probing.masks) <= 2 ** probing.bits and r["recall"] >= 0.85
    true = {(r["k"], r["nn_key"]): r["dist"] for r in exact.collect()}
    for r in found.collect():  # distances are exact, ranks are those of what was found
        assert (r["k"], r["nn_key"]) not in true or abs(true[r["k"], r["nn_key"]] - r["dist"]) < 1e-9


def test_masks_come_cheapest_first():
    costs = np.array([0.1, 0.25, 0.3, 0.9, 1.0])
    masks = S.cheapest_masks(costs, 32)
    sums = (masks * costs).sum(axis=1)
    assert len({m.tobytes() for m in masks}) == 32 and (np.diff(sums) > -1e-12).all()
    every = sorted(sum(c for c, b in zip(costs, bits) if b) for bits in itertools.product((0, 1), repeat=5))
    assert np.allclose(sums, every)
    assert [S.signature_bits(n, 1, 256) for n in (0, 256, 257, 1 << 20, 1 << 40)] == [0, 0, 1, 12, S.MAX_BITS]


def test_empty_table(spark):
    df = spark.createDataFrame([], "k long, v array<double>")
    assert S.knn_of(df, "k", "v", F.lit(True))[0].count() == 0
