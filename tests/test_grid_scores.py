"""Scores of a grid's models, made in one scan."""

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskframe.plans import models as M
from riskframe.plans import catalog  # noqa: F401  (registers the queries in order)
from riskframe.plans import q_models as Q


def frame(spark):
    rows = [(i, 1 + int(i * 37 % 11 > 5), "train" if i % 3 else ("val" if i % 2 else "test"), Vectors.dense([float(i % 7), float(i * 37 % 11 + i % 5)])) for i in range(300)]
    x = spark.createDataFrame([(*r, float(r[1] - 1), 1.0) for r in rows], ["app_id", "class", "split", "features", "label", "weight"])
    return x.withColumn("class", F.col("class").cast("int")).repartition(3)


def test_scores_are_those_of_each_model(spark):
    x = frame(spark)
    train = x.where("split = 'train'")
    models = {i: M.logistic(train, C=c, penalty="l2").fit(train) for i, c in ((1, 0.001), (4, 10.0))}
    found = M.predict_each(models, x, "config_id", ("app_id", "split"))
    assert found.columns == ["config_id", "app_id", "split", "yhat", "p"]
    want = {(i, r["app_id"]): (r["yhat"], r["p"]) for i, m in models.items() for r in M.predict(m, x).collect()}
    assert {(r["config_id"], r["app_id"]): (r["yhat"], r["p"]) for r in found.collect()} == want and len(want) == 600


def test_a_grid_is_scored_once(spark, monkeypatch):
    """One report for all configurations; those that failed have their error."""
    reports = []
    own = M.classification_report
    monkeypatch.setattr(Q, "_frames", lambda spark, sf: (frame(spark), None))
    monkeypatch.setattr(M, "classification_report", lambda *a: reports.append(a) or own(*a))
    res, x = Q.c_grid(spark, "", [0.01, -1.0, 10.0])
    rows = {r["config_id"]: r for r in res.collect()}
    assert len(reports) == 1 and rows[2]["error"] and rows[2]["val_f1"] is None and sorted(rows) == [1, 2, 3]
    train = x.where("split = 'train'")
    for i, c in ((1, 0.01), (3, 10.0)):
        for r in own(M.predict(M.logistic(train, C=c, penalty="l2").fit(train), x.where("split <> 'train'"))).collect():
            got = [rows[i][f"{r['split']}_{m}"] for m in ("accuracy", "f1", "roc_auc")]
            assert all(abs(a - b) < 1e-9 for a, b in zip(got, (r["accuracy"], r["f1_pos2"], r["roc_auc"]))) and rows[i]["error"] is None
    res, _ = Q.c_grid(spark, "", [-1.0])
    assert res.first()["error"] and res.count() == 1
