"""Differential checks of the regularisation mappings (numpy closed form / KKT)."""

import numpy as np
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import DoubleType, StructField, StructType

from riskframe.plans import models as M


def _frame(spark, X, y, w=None):
    w = np.ones(len(y)) if w is None else w
    rows = [(Vectors.dense(x.tolist()), float(t), float(t), float(wi)) for x, t, wi in zip(X, y, w)]
    schema = StructType([StructField("features", VectorUDT()), StructField("label", DoubleType()),
                         StructField("y_reg", DoubleType()), StructField("weight", DoubleType())])
    return spark.createDataFrame(rows, schema)


def test_ols_matches_lstsq(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(200, 3))
    y = 1.0 + X @ np.array([0.5, -1.0, 2.0]) + rng.normal(scale=0.1, size=200)
    df = _frame(spark, X, y)
    model = M.linear_regression(df, "ols").fit(df)
    A = np.hstack([X, np.ones((200, 1))])
    sol = np.linalg.lstsq(A, y, rcond=None)[0]
    assert np.allclose(model.coefficients.toArray(), sol[:3], atol=1e-6)
    assert abs(model.intercept - sol[3]) < 1e-6


def test_ridge_mapping_matches_closed_form(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(300, 4))
    y = 2.0 + X @ np.array([1.0, 0.0, -0.5, 0.25]) + rng.normal(scale=0.3, size=300)
    alpha = 10.0
    df = _frame(spark, X, y)
    model = M.linear_regression(df, "ridge", alpha=alpha).fit(df)
    Xc, yc = X - X.mean(0), y - y.mean()
    b = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(4), Xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), b, atol=1e-3)


def test_logistic_l2_mapping_satisfies_kkt(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(400, 3))
    p = 1 / (1 + np.exp(-(X @ np.array([1.5, -2.0, 0.5]) - 0.3)))
    y = (rng.random(400) < p).astype(float)
    C = 0.5
    df = _frame(spark, X, y)
    model = M.logistic(df, C=C, penalty="l2", balanced=False, max_iter=500).fit(df)
    beta, b0 = model.coefficients.toArray(), model.intercept
    q = 1 / (1 + np.exp(-(X @ beta + b0)))
    # scikit-learn objective: 0.5 |beta|^2 + C * sum(logloss); gradient must vanish
    grad = beta + C * X.T @ (q - y)
    grad0 = C * np.sum(q - y)
    assert np.linalg.norm(grad) < 1e-2 * max(1.0, np.linalg.norm(beta))
    assert abs(grad0) < 1e-2


def test_unsupported_tree_knob_rejected(spark):
    try:
        M.decision_tree(min_samples_split=5)
        raise AssertionError("expected ValueError")
    except ValueError as exc:
        assert "min_samples_split" in str(exc)
