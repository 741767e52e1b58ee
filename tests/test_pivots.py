"""Largest similarity of every row against a comparison of all pairs."""

import math

import numpy as np
import pytest

from riskframe.operators import pivots as V


def brute(left, right):
    def cos(a, b):
        x, y = math.sqrt(sum(v * v for v in a)), math.sqrt(sum(v * v for v in b))
        return sum(p * q for p, q in zip(a, b)) / (x * y) if x and y else 0.0
    return {k: round(max(cos(a, b) for _, b in right), 6) + 0.0 for k, a in left}


def vectors(n, dims, seed, start, centres=6):
    rng = np.random.default_rng(seed)
    c = np.random.default_rng(9).normal(size=(centres, dims))
    return [(start + i, (c[i % centres] + 0.2 * rng.normal(size=dims)).tolist()) for i in range(n)]


@pytest.mark.parametrize("block_rows,centres", [(5, None), (2048, None), (7, 1), (4, 30)])
def test_every_row_gets_its_maximum(spark, block_rows, centres):
    left, right = vectors(90, 8, 1, 0), vectors(400, 8, 2, 1000)
    left += [(500 + i, left[0][1]) for i in range(30)] + [(600, [0.0] * 8), (601, [-x for x in right[3][1]]), (602, right[5][1])]
    right += [(5000 + i, right[7][1]) for i in range(100)] + [(9000, [0.0] * 8)]
    L, R = (spark.createDataFrame([(str(k), v, 1) for k, v in rows], "k string, v array<double>, q long").repartition(3) for rows in (left, right))
    got = V.max_similarity(L, R, "k", "v", block_rows=block_rows, centres=centres).collect()
    assert len(got) == len(left)
    want = brute(left, right)
    assert {int(r["k"]): r["max_similarity"] + 0.0 for r in got} == pytest.approx(want, abs=1.1e-6)
    if centres is None and block_rows == 5:  # near clusters are enough for most rows
        assert sum(r["compared"] for r in got if int(r["k"]) < 90) < 0.6 * 90 * 402


def test_empty_sides(spark):
    L = spark.createDataFrame([(1, [1.0, 0.0])], "k long, v array<double>")
    none = spark.createDataFrame([], "k long, v array<double>")
    assert [tuple(r) for r in V.max_similarity(L, none, "k", "v").collect()] == [(1, None, 0)]
    assert V.max_similarity(none, L, "k", "v").count() == 0


def test_summary(spark):
    L = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0])], "k long, v array<double>")
    R = spark.createDataFrame([(3, [2.0, 0.0]), (4, [1.0, 1.0])], "k long, v array<double>")
    r = V.similarity_summary(L, R, "k", "v").first()
    assert (r.n_rows, r.n_flagged, r.least, r.mean, r.largest) == (2, 1, 0.707107, 0.853553, 1.0) and r.n_compared <= 4


def test_links_above_a_low_threshold_are_counted(spark):
    from riskframe.operators import neighbors as N
    left, right = vectors(40, 8, 1, 0), vectors(300, 8, 2, 1000)
    left += [(600, [0.0] * 8), (601, left[3][1])]
    right += [(5000 + i, right[7][1]) for i in range(50)] + [(9000, [0.0] * 8)]
    L, R = (spark.createDataFrame(rows, "k long, v array<double>").repartition(3) for rows in (left, right))
    x, y = (np.array([v for _, v in rows]) for rows in (left, right))
    x, y = (m / np.maximum(np.linalg.norm(m, axis=1), 1e-300)[:, None] for m in (x, y))
    for t in (0.4, -0.5, 0.9):
        want = {k: int(n) for (k, _), n in zip(left, (x @ y.T > t).sum(axis=1))}
        got = N.similar_counts(L, R, "k", "v", t).collect()
        assert {r.k: r.n_links for r in got} == want and len(got) == len(left)
        assert {r.k: r.class_id for r in got if r.k in (3, 601)} == {3: 3, 601: 3}
    odd = L.limit(1).unionByName(spark.createDataFrame([(700, None), (701, None), (702, [None] + [1.0] * 7)], L.schema))
    got = N.similar_counts(odd, R.unionByName(odd.where("k > 601")), "k", "v", 0.4).where("k > 601").collect()
    assert sorted((r.k, r.class_id, r.n_links) for r in got) == [(700, 700, 0), (701, 700, 0), (702, 702, 0)]


def test_a_query_travels_once_to_a_bucket(spark, monkeypatch):
    """Its rows in the join do not grow with the blocks that it meets."""
    monkeypatch.setattr(V, "BUCKET_VALUES", 8 * 100)
    right = spark.createDataFrame(vectors(400, 8, 2, 1000), "k long, v array<double>")
    _, vecs = V.unit_vectors(right, "k", "v", "t")
    index = V.build_index(vecs, 8, centres=20, block_rows=5)
    assert len(index.centre) >= 80 and index.buckets.count() == len(set(index.bucket)) <= 5
    assert sum(len(b["ids"]) // 8 for r in index.buckets.collect() for b in r.blocks) == 400
