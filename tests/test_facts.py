"""The facts about fitted models must be false for a wrong model."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

import riskframe.plans.catalog  # noqa: F401  (registers the queries)
from riskframe.operators import moments as MO
from riskframe.plans import models as M
from riskframe.plans import q_checks as Q
from riskframe.plans.q_models import _frames, linear_configs, penalties
from riskframe.session import materialise
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def frame(spark):
    x, prep = _frames(spark, SF_SMALL)
    return materialise(x.withColumn("x", vector_to_array("features")), "facts"), prep


def test_logistic_penalties_are_told_apart(frame):
    x, _ = frame
    train = x.where("split = 'train'")
    fits = {p: M.logistic(train, C=1.0, penalty=p, tol=Q.PRECISE).fit(train) for p in ("l1", "l2")}
    fits["none"] = M.logistic(train, C=1e12, penalty="l2", tol=Q.PRECISE).fit(train)
    fits["C=2"] = M.logistic(train, C=2.0, penalty="l2", tol=Q.PRECISE).fit(train)
    assert {(p, name): Q.logistic_optimal(m, x, p) for p in ("l1", "l2") for name, m in fits.items()} == {
        (p, name): p == name for p in ("l1", "l2") for name in fits}


def test_linear_models_are_told_apart(frame):
    x, prep = frame
    m = MO.Moments.collect(MO.moments(x, "x", "y_reg", "split"), "split", prep.n_features)["train"]
    train = x.where("split = 'train'")
    kinds = {"LinearRegression": ("ols", 0.0), "Ridge": ("ridge", 1.0), "Lasso": ("lasso", 0.01), "ElasticNet": ("elasticnet", 0.01)}
    fits = {k: M.linear_regression(train, kind, alpha=a, l1_ratio=0.5, tol=Q.PRECISE).fit(train).coefficients.toArray() for k, (kind, a) in kinds.items()}
    for k, (_, a) in kinds.items():
        l1, l2 = penalties({"model_type": k, "alpha": a, "l1_ratio": 0.5}, m.n)
        assert {other: Q.near_minimum(m, w, l1, l2, True) for other, w in fits.items()} == {other: other == k for other in fits}


def test_an_untrained_network_fails(frame):
    x, prep = frame
    train = x.where("split = 'train'")
    assert Q.better_than_constant(M.mlp(prep.n_features, (8,), max_iter=60).fit(train), train) == (True, True)
    assert not Q.better_than_constant(M.mlp(prep.n_features, (8,), max_iter=0).fit(train), train)[0]


def test_moments_give_the_errors_of_any_model(spark):
    rng = np.random.default_rng(3)
    rows = [("a" if i % 3 else "b", rng.normal(size=4).tolist(), float(rng.normal())) for i in range(200)] + [("b", [0.0] * 4, 2.0)] * 50
    df = spark.createDataFrame(rows, "part string, x array<double>, y double").repartition(5)
    by = MO.Moments.collect(MO.moments(df, "x", "y", "part"), "part", 4)
    models = [(rng.normal(size=4), 0.3), (np.zeros(4), 0.0)]
    scanned = {(r["part"], r["model"]): r for r in MO.scan_errors(df, "x", "y", "part", models).collect()}
    for part in "ab":
        own = [(np.array(x), y) for p, x, y in rows if p == part]
        y = np.array([b for _, b in own])
        for k, (w, b0) in enumerate(models):
            miss = np.array([b - (a * w).sum() - b0 for a, b in own])
            e, r = by[part].errors(w, b0), scanned[part, k]
            assert np.isclose(e["rmse"], np.sqrt((miss ** 2).mean())) and np.isclose(e["r2"], 1 - (miss ** 2).sum() / ((y - y.mean()) ** 2).sum())
            assert np.isclose(r["mae"], np.abs(miss).mean()) and np.isclose(r["rmse"], e["rmse"]) and r["n"] == len(own)
        w = by[part].least_squares()
        assert abs(by[part].above_minimum(w, 0.0, 0.0)) < 1e-12 and by[part].above_minimum(w + 0.1, 0.0, 0.0) > 1e-4
    empty = spark.createDataFrame([], df.schema)
    assert MO.moments(empty, "x", "y", "part").count() == 0


def test_elimination_leaves_flat_directions_at_zero():
    a = np.array([[2.0, 2.0, 0.0], [2.0, 2.0, 0.0], [0.0, 0.0, 3.0]])
    x = MO.solve(a, np.array([4.0, 4.0, 6.0]))
    assert np.allclose((a * x).sum(axis=1), [4, 4, 6])


def test_the_linear_grid_is_whole():
    configs = linear_configs()
    assert len(configs) == 98 and [c["config_id"] for c in configs] == list(range(1, 99))


def test_a_few_rows_have_the_moments_of_all(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=(400, 3)), np.full(400, 2.0)])
    x = np.column_stack([x, x[:, 0] - x[:, 1]])       # a constant and a dependent column
    y = x[:, 0] - 0.5 * x[:, 2] + rng.normal(size=400)
    z = np.column_stack([y, np.ones(400), x])
    m = MO.Moments(z.T @ z)
    few = m.equivalent_rows()
    assert len(few) <= 2 * 6 and np.allclose(few.mean(axis=0), np.column_stack([y, x]).mean(axis=0))
    assert np.allclose(few.T @ few / len(few), np.column_stack([y, x]).T @ np.column_stack([y, x]) / 400) and np.all(few[:, 4] == 2.0)
    assert np.isclose(m.deviation(), y.std())
    same = MO.Moments(np.full((4, 4), 10.0)).equivalent_rows()      # ten equal rows
    assert np.allclose(same, 1.0) and len(same) == 1


def test_the_gradient_adds_up_in_tasks(spark):
    rng = np.random.default_rng(6)
    x, r = rng.normal(size=(60, 3)), rng.normal(size=60)
    x[:, 2] = 0.0
    rows = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, r)] + [(Vectors.dense([9.0] * 3), None)], ["features", "res"]).repartition(4)
    g, total = Q._gradient(rows, rows["res"], 3)
    assert np.allclose(g, r @ x) and np.isclose(total, r.sum())


@pytest.mark.parametrize("name", ["l8_learning_curves", "l8_learning_curves_checked"])
def test_learning_curves_prepare_one_frame(spark, frame, monkeypatch, name):
    from riskframe.plans import q_models
    made = []

    def counted(spark, sf):
        made.append(sf)
        return frame
    monkeypatch.setattr(q_models, "_frames", counted)
    monkeypatch.setattr(Q, "_frames", counted)
    assert riskframe.plans.catalog.QUERIES[name](spark, SF_SMALL).count() > 0
    assert made == [SF_SMALL]
