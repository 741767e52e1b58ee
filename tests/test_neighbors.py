"""Exact k-NN, SMOTE and leakage against brute force on small fixtures."""

import math
import random

from pyspark.sql import functions as F

from riskframe.operators import neighbors as N


def _brute_knn(points, k):
    """The k nearest other rows by (distance, key)."""
    out = {}
    for key, v in points:
        near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, u))), other) for other, u in points if other != key)
        out[key] = [(i + 1, other, round(d, 9)) for i, (d, other) in enumerate(near[:k])]
    return out


def test_knn_matches_brute_force_with_duplicates(spark):
    rnd = random.Random(3)
    pts = [(i, [rnd.randint(0, 5) * 1.0, rnd.random() * 3, rnd.gauss(0, 1)]) for i in range(120)]
    pts += [(1000 + i, [1.0, 1.0, 1.0]) for i in range(40)]          # a hot group of copies
    df = spark.createDataFrame(pts, "k long, v array<double>")
    got = {}
    for r in N.knn(df, "k", "v", k=5).collect():
        got.setdefault(r["k"], []).append((r["rank"], r["nn_key"], round(r["dist"], 9)))
    want = _brute_knn(pts, 5)
    assert {k: sorted(v) for k, v in got.items()} == want


def test_knn_groups_and_small_groups(spark):
    df = spark.createDataFrame([(i, i % 2, [float(i)]) for i in range(20)], "k long, g int, v array<double>")
    nn = N.knn(df, "k", "v", k=2, group_cols=["g"]).where(F.col("k") == 10).orderBy("rank").collect()
    assert [(r["nn_key"], r["dist"]) for r in nn] == [(8, 2.0), (12, 2.0)]
    tiny = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "k long, v array<double>")
    assert sorted((r["k"], r["rank"], r["nn_key"]) for r in N.knn(tiny, "k", "v", k=5).collect()) == [(1, 1, 2), (2, 1, 1)]


def test_smote_balances_and_stays_on_segments(spark):
    rows = [(i, 1, [float(i), 0.0]) for i in range(30)] + [(100 + i, 2, [float(i), 1.0]) for i in range(8)]
    df = spark.createDataFrame(rows, "k long, y int, v array<double>")
    out = N.smote(df, "k", "v", "y", k=3, seed=1)
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {1: 30, 2: 30}
    syn = out.where("synthetic").collect()
    assert len(syn) == 22
    for r in syn:
        assert r["v"][1] == 1.0 and 0.0 <= r["v"][0] <= 7.0
    again = {(r["syn_id"], tuple(r["v"])) for r in N.smote(df.repartition(5), "k", "v", "y", k=3, seed=1)
             .where("synthetic").collect()}
    assert again == {(r["syn_id"], tuple(r["v"])) for r in syn}


def test_similar_pairs_match_brute_force(spark):
    rnd = random.Random(5)
    left = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    right = [(100 + i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(80)] + [(999, [0.0, 0.0, 0.0, 0.0])]
    L = spark.createDataFrame(left, "k long, v array<double>")
    R = spark.createDataFrame(right, "k long, v array<double>")

    def cos(a, b):
        na, nb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
        return 0.0 if na == 0 or nb == 0 else sum(x * y for x, y in zip(a, b)) / (na * nb)
    for t in (0.9, 0.5, -0.2):
        want = {(a, b) for a, va in left for b, vb in right if cos(va, vb) > t}
        got = {(r["left_key"], r["right_key"]) for r in N.similar_pairs(L, R, "k", "v", t).collect()}
        assert got == want, t


def test_signature_buckets_find_planted_copies_among_many(spark):
    rnd = random.Random(6)
    right = [(i, [rnd.gauss(0, 1) for _ in range(32)]) for i in range(600)] + [(5000 + i, [1.0] * 32) for i in range(50)]
    left = [(10000 + i, [x + rnd.gauss(0, 0.15) for x in v]) for i, v in right[:40]] + [(20000, [1.0] * 32)]
    L, R = (spark.createDataFrame(x, "k long, v array<double>") for x in (left, right))

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    want = {(a, b) for a, va in left for b, vb in right if cos(va, vb) > 0.95}
    got = {(r["left_key"], r["right_key"]) for r in N.similar_pairs(L, R, "k", "v", 0.95).collect()}
    assert got == want and len(want) > 80
    assert N.hash_tables(0.95, 14, 1e-6) < 80
