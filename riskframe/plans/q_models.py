"""Catalog entries for MLlib learners and their runs (M1-M11, S6, S7, G2, G3,
G11, L8).  Model-dependent: the driver checks rows; tests check the
regularisation mappings and the metric plumbing."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskframe.operators import moments as MO
from riskframe.operators import tune as G
from riskframe.plans import models as M
from riskframe.plans.catalog import CAT, NUM, query, split_apps
from riskframe.session import materialise, scratch_path

EVAL_SPLITS = ("val", "test")


def _frames(spark, sf):
    return M.linear_frame(split_apps(spark, sf), NUM, CAT)


def _fit_logistic(spark, sf, C=1.0, penalty="l1", tol=1e-6, frames=None):
    x, prep = frames or _frames(spark, sf)
    train = x.where(F.col("split") == "train")
    return M.logistic(train, C=C, penalty=penalty, tol=tol).fit(train), x, prep


def _eval(x):
    return x.where(F.col("split").isin(*EVAL_SPLITS))


@query("m1_logistic_l1")
def _m1(spark, sf):
    model, x, _ = _fit_logistic(spark, sf, 1.0, "l1")
    return M.classification_report(M.predict(model, _eval(x)))


@query("m2_logistic_l2")
def _m2(spark, sf):
    model, x, _ = _fit_logistic(spark, sf, 1.0, "l2")
    return M.classification_report(M.predict(model, _eval(x)))


def _tree_frame(spark, sf):
    return M.tree_frame(split_apps(spark, sf), NUM, CAT)


@query("m3_decision_tree")
def _m3(spark, sf):
    x = _tree_frame(spark, sf)
    model = M.decision_tree(max_depth=5, balanced=True).fit(x.where(F.col("split") == "train"))
    return M.classification_report(M.predict(model, _eval(x)))


@query("m4_tree_feature_subset")
def _m4(spark, sf):
    x = _tree_frame(spark, sf)
    model = M.decision_tree(max_depth=5, balanced=True, max_features="sqrt").fit(x.where(F.col("split") == "train"))
    return M.classification_report(M.predict(model, _eval(x)))


@query("m5_tree_regressor")
def _m5(spark, sf):
    x = _tree_frame(spark, sf)
    model = M.tree_regressor(5, 30).fit(x.where(F.col("split") == "train"))
    return M.regression_report(M.predict(model, _eval(x), classifier=False))


def _linreg(spark, sf, kind, **kw):
    x, prep = _frames(spark, sf)
    train = x.where(F.col("split") == "train")
    model = M.linear_regression(train, kind, **kw).fit(train)
    rep = M.regression_report(M.predict(model, _eval(x), classifier=False))
    return rep.withColumn("n_nonzero", F.lit(M.nonzero_count(model)))


@query("m6_ols")
def _m6(spark, sf):
    return _linreg(spark, sf, "ols")


@query("m7_ridge")
def _m7(spark, sf):
    return _linreg(spark, sf, "ridge", alpha=1.0)


@query("m8_lasso")
def _m8(spark, sf):
    return _linreg(spark, sf, "lasso", alpha=0.01)


@query("m9_elasticnet")
def _m9(spark, sf):
    return _linreg(spark, sf, "elasticnet", alpha=0.01, l1_ratio=0.5)


def _fit_mlp(spark, sf, frames=None):
    x, prep = frames or _frames(spark, sf)
    train = x.where(F.col("split") == "train")
    return M.mlp(prep.n_features, (64, 32), max_iter=50).fit(train), x


@query("m10_mlp")
def _m10(spark, sf):
    model, x = _fit_mlp(spark, sf)
    return M.classification_report(M.predict(model, _eval(x)))


@query("m11_predict_proba")
def _m11(spark, sf):
    model, x, _ = _fit_logistic(spark, sf)
    return M.predict(model, _eval(x))


@query("s6_model_roundtrip")
def _s6(spark, sf):
    model, x, _ = _fit_logistic(spark, sf)
    path = M.save_model(model, scratch_path(spark, "model-logistic"))
    return M.classification_report(M.predict(M.load_model(path), _eval(x)))


@query("s7_loss_curve")
def _s7(spark, sf):
    model, _, _ = _fit_logistic(spark, sf)
    path = scratch_path(spark, "loss-curve")
    M.loss_curve(model, "logistic_l1").write.mode("overwrite").parquet(path)
    return spark.read.schema("run_id string, epoch int, loss double, val_loss double").parquet(path)


@query("l8_learning_curves")
def _l8(spark, sf):
    frames = _frames(spark, sf)     # one frame for both models
    lr, _, _ = _fit_logistic(spark, sf, frames=frames)
    nn, _ = _fit_mlp(spark, sf, frames=frames)
    return M.loss_curve(lr, "classification:logistic").unionByName(M.loss_curve(nn, "classification:mlp"))


# ---------------------------------------------------------------- grids over fitted models
# The C grid of the L2 logistic search; C = -1 is an invalid
# configuration kept on purpose to show that failures are recorded.
C_GRID = [0.001, 0.01, 0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 50.0, 100.0]


def c_grid(spark, sf, grid=C_GRID):
    x, _ = _frames(spark, sf)
    train = x.where(F.col("split") == "train")
    total = train.agg(F.sum("weight")).first()[0]
    cfgs = [{"config_id": i + 1, "C": float(c)} for i, c in enumerate(grid)]
    rows = M.fit_grid(cfgs, lambda cfg: M.logistic(train, C=cfg["C"], penalty="l2", total=total), train, lambda model: {"model": model})
    good = {r["config_id"]: r for r in rows if r["error"] is None}
    if good:    # all of them in one scan
        scores = materialise(M.predict_each({i: r["model"] for i, r in good.items()}, _eval(x), "config_id", ("class", "split")), "grid-scores")
        for r in M.classification_report(scores, ["config_id", "split"]).collect():
            good[r["config_id"]] |= {f"{r['split']}_accuracy": r["accuracy"], f"{r['split']}_f1": r["f1_pos2"], f"{r['split']}_roc_auc": r["roc_auc"]}
    names = [f"{s}_{m}" for s in EVAL_SPLITS for m in ("accuracy", "f1", "roc_auc")]
    schema = "config_id int, C double, " + ", ".join(f"{n} double" for n in names) + ", error string"
    return spark.createDataFrame([{k: r.get(k) for k in ("config_id", "C", *names, "error")} for r in rows], schema), x


@query("g2_fit_score_grid")
def _g2(spark, sf):
    return c_grid(spark, sf)[0]


@query("g3_failed_configs")
def _g3(spark, sf):
    res, _ = c_grid(spark, sf, C_GRID + [-1.0])
    return res.where(F.col("error").isNotNull())


@query("g11_refit_best")
def _g11(spark, sf):
    res, x = c_grid(spark, sf)
    best = G.best_config(res.where(F.col("error").isNull()), "val_f1").first()
    train = x.where(F.col("split") == "train")
    model = M.logistic(train, C=best["C"], penalty="l2").fit(train)
    rep = M.classification_report(M.predict(model, x.where(F.col("split") == "test")))
    return rep.select(F.lit(best["config_id"]).alias("config_id"), F.lit(best["C"]).alias("C"),
                      F.lit(best["val_f1"]).alias("val_f1"), F.col("accuracy").alias("test_accuracy"),
                      F.col("f1_pos2").alias("test_f1"), F.col("roc_auc").alias("test_roc_auc"))


# The linear grid of the blueprint, 98 configurations.
RIDGE_LASSO_ALPHAS = [0.001, 0.01, 0.1, 0.5, 1.0, 5.0, 10.0, 50.0, 100.0]
ELASTIC_ALPHAS, ELASTIC_RATIOS = [0.01, 0.1, 0.5, 1.0, 5.0, 10.0], [0.1, 0.3, 0.5, 0.7, 0.9]
_KINDS = {"LinearRegression": "ols", "Ridge": "ridge", "Lasso": "lasso", "ElasticNet": "elasticnet"}
NONZERO = 1e-5


def linear_configs():
    """The grid in the order of the search."""
    flat = [("LinearRegression", None, None)] + [(m, a, None) for m in ("Ridge", "Lasso") for a in RIDGE_LASSO_ALPHAS]
    flat += [("ElasticNet", a, r) for a in ELASTIC_ALPHAS for r in ELASTIC_RATIOS]
    return [{"config_id": i + 1, "model_type": m, "alpha": a, "l1_ratio": r, "fit_intercept": f}
            for i, (m, a, r, f) in enumerate((m, a, r, f) for m, a, r in flat for f in (True, False))]


def penalties(cfg, n):
    """L1 and L2 strengths of a configuration, per row of the mean loss."""
    alpha, ratio = cfg["alpha"] or 0.0, cfg["l1_ratio"]
    return {"LinearRegression": (0.0, 0.0), "Ridge": (0.0, alpha / n), "Lasso": (alpha, 0.0)}.get(cfg["model_type"]) or (alpha * ratio, alpha * (1 - ratio))


def moments_frame(spark, sf, keep=("features",)):
    """The linear frame with its features as an array, written once."""
    x, prep = _frames(spark, sf)
    return materialise(x.select("app_id", "split", "y_reg", *keep, vector_to_array("features").alias("x")), "linear-moments"), prep


def linear_grid(spark, sf, configs=None, tol=1e-6):
    """Fit every configuration (MLlib), then score all of them: squared errors
    and R squared from one table of moments, absolute errors from one scan.
    A least-squares objective depends on the rows by their moments alone, so
    the fits run on the few rows that have the moments of all training rows.
    Returns the fitted rows (in memory, one a configuration) and the moments
    by split."""
    frame, prep = moments_frame(spark, sf, keep=())
    by_split = MO.Moments.collect(MO.moments(frame, "x", "y_reg", "split"), "split", prep.n_features)
    own = by_split["train"]
    few = own.equivalent_rows()
    train = spark.createDataFrame([(Vectors.dense(r[1:]), float(r[0])) for r in few], ["features", "y_reg"]).coalesce(1)
    # MLlib divides a ridge penalty by the sample deviation of the rows that it is given
    sample_sd = {m: own.deviation() * (m / max(1.0, m - 1.0)) ** 0.5 for m in (len(few), own.n)}
    fitted = M.fit_grid(configs or linear_configs(), lambda c: M.linear_regression(
        train, _KINDS[c["model_type"]], alpha=c["alpha"] or 0.0, l1_ratio=c["l1_ratio"] or 0.5, fit_intercept=c["fit_intercept"], tol=tol,
        stats=(own.n, sample_sd[len(few) if c["model_type"] == "Ridge" else own.n])), train, lambda model: {"coef": model.coefficients.toArray(), "intercept": float(model.intercept)}, parallelism=8)
    good = [r for r in fitted if r["error"] is None]
    scanned = MO.scan_errors(frame.where(F.col("split").isin(*EVAL_SPLITS)), "x", "y_reg", "split", [(r["coef"], r["intercept"]) for r in good]).collect()
    for r in scanned:
        good[r["model"]][f"{r['split']}_mae"], good[r["model"]][f"{r['split']}_scan_rmse"] = r["mae"], r["rmse"]
    for r in good:
        r["n_features_used"] = int((abs(r["coef"]) > NONZERO).sum())
        for s in EVAL_SPLITS:
            r |= {f"{s}_{k}": v for k, v in by_split[s].errors(r["coef"], r["intercept"]).items()}
    return fitted, by_split


LINEAR_SCHEMA = ("config_id int, model_type string, alpha double, l1_ratio double, fit_intercept boolean, "
                 + ", ".join(f"{s}_{m} double" for s in EVAL_SPLITS for m in ("mae", "rmse", "r2")) + ", n_features_used int, error string")


def linear_results(spark, sf):
    fitted, _ = linear_grid(spark, sf)
    names = [c.split()[0] for c in LINEAR_SCHEMA.split(", ")]
    return spark.createDataFrame([{k: r.get(k) for k in names} for r in fitted], LINEAR_SCHEMA)


@query("g2_linear_grid")
def _g2_linear(spark, sf):
    """Least squares, ridge, lasso and elastic net over strength, mixing and
    intercept: 98 fits, with validation and test errors."""
    return linear_results(spark, sf)


@query("g2_linear_grid_best")
def _g2_linear_best(spark, sf):
    """The first configuration with the least validation RMSE, and the mean
    test errors per model type."""
    res = materialise(linear_results(spark, sf), "linear-grid").where(F.col("error").isNull())
    best = G.best_config(res, "val_rmse", ascending=True).select(F.lit("best").alias("what"), "model_type", "test_rmse", "test_mae", "test_r2")
    mean = res.groupBy("model_type").agg(*(F.avg(c).alias(c) for c in ("test_rmse", "test_mae", "test_r2")))
    return best.unionByName(mean.select(F.lit("mean").alias("what"), "model_type", "test_rmse", "test_mae", "test_r2"))


@query("g2_moments")
def _g2_moments(spark, sf):
    """Second moments of the design per split (-1: the target, 0: the constant)."""
    frame, _ = moments_frame(spark, sf)
    found = MO.moments(frame, "x", "y_reg", "split")
    return found.select("split", "i", "j", (F.round("value", 4) + 0.0).alias("value")).where("value <> 0")


# ---------------------------------------------------------------- cross-validation with fitting inside each fold
CV_ITERATIONS = 50
CV_MEASURES = ["accuracy", "precision", "recall", "f1", "roc_auc"]


def cv_models(n_rows: int, n_features: int) -> dict:
    """The two learners; oversampled rows are balanced, so no weights."""
    return {"logistic_l1": M.LogisticRegression(featuresCol="features", labelCol="label", regParam=1.0 / n_rows, elasticNetParam=1.0, standardization=False, maxIter=1000),
            "mlp": M.mlp(n_features, (64, 32), max_iter=CV_ITERATIONS)}


def fold_setup(spark, sf):
    """Folds, the preparation of every fit part, and the synthetic rows as
    ``(fit_fold, syn_id, base_key, nn_key, gap)``."""
    from riskframe.functions.hashing import uniform
    from riskframe.operators import folds as FO
    from riskframe.plans.catalog import SEED
    from riskframe.plans.q_neighbors import FOLDS, fold_pool, oversampled_folds
    pool = fold_pool(spark, sf)
    with ThreadPoolExecutor(max_workers=1) as beside:       # two chains of jobs that don't need each other
        preps = beside.submit(FO.fit_folds, pool.select("app_id", "class", "fold", *NUM, *CAT), NUM, CAT, "fold", FOLDS)
        made = oversampled_folds(pool).where("synthetic").select("fit_fold", "syn_id", "base_key", "nn_key", uniform("fit_fold", "syn_id", seed=f"gap{SEED}").alias("gap"))
        made = materialise(made, "fold-synthetic")
        return preps.result(), made, FOLDS


def cv_fitted_per_fold(spark, sf):
    """Per (model, fold): five metrics on the held-out fold of models fitted on
    the prepared and oversampled fit part.  Synthetic rows lie between the
    prepared vectors of a row and of one of its neighbours (R4)."""
    preps, made, k = fold_setup(spark, sf)

    def one(f: int) -> list[dict]:
        x = materialise(preps.frame(f, ["app_id", "class", "fold"]).withColumn("label", (F.col("class") - 1).cast("double")), f"fold-{f}")
        vec = x.select("app_id", vector_to_array("features").alias("v"))
        between = F.zip_with("_a", "_b", lambda a, b: a + F.col("gap") * (b - a))
        new = (made.where(F.col("fit_fold") == f).join(vec.select(F.col("app_id").alias("base_key"), F.col("v").alias("_a")), "base_key")
               .join(vec.select(F.col("app_id").alias("nn_key"), F.col("v").alias("_b")), "nn_key")
               .select(array_to_vector(between).alias("features"), F.lit(1.0).alias("label")))
        train = materialise(x.where(F.col("fold") != f).select("features", "label").unionByName(new), f"fit-{f}")
        held = x.where(F.col("fold") == f).withColumn("split", F.lit("test"))
        rows = []
        for name, learner in cv_models(train.count(), preps.preps[f].n_features).items():
            r = M.classification_report(M.predict(learner.fit(train), held)).first()
            rows.append({"model": name, "fold": f, "accuracy": r["accuracy"], "precision": r["precision_pos2"], "recall": r["recall_pos2"],
                         "f1": r["f1_pos2"], "roc_auc": r["roc_auc"]})
        return rows
    with ThreadPoolExecutor(max_workers=k) as pool:
        rows = [r for part in pool.map(one, range(k)) for r in part]
    return spark.createDataFrame(rows, "model string, fold int, " + ", ".join(f"{m} double" for m in CV_MEASURES))


@query("g12_cv_fitted")
def _g12_fitted(spark, sf):
    """5-fold CV of an L1 logistic model and a network on the train+val pool:
    vocabulary, scaler, oversampling and model are fitted on each fold's fit
    part only; mean and population std of five metrics (positive class: 2)."""
    return G.fold_summary(cv_fitted_per_fold(spark, sf), ["model"], CV_MEASURES)


@query("g12_cv_winners")
def _g12_winners(spark, sf):
    """The model with the best mean of each metric over the folds."""
    s = materialise(G.fold_summary(cv_fitted_per_fold(spark, sf), ["model"], CV_MEASURES), "cv-summary")
    long = s.unpivot(["model"], [f"mean_{m}" for m in CV_MEASURES], "metric", "mean")
    return G.winner_per_metric(long)


@query("g12_fold_facts")
def _g12_facts(spark, sf):
    """Per fold: rows of the fit part and of the held-out fold, synthetic rows,
    features, and the fitted mean and deviation of two columns."""
    preps, made, k = fold_setup(spark, sf)
    sizes = preps.rows.groupBy("fold").count().collect()
    total = sum(r["count"] for r in sizes)
    held = {r["fold"]: r["count"] for r in sizes}
    new = {r["fit_fold"]: r["count"] for r in made.groupBy("fit_fold").count().collect()}
    rows = [(f, total - held[f], held[f], new.get(f, 0), p.n_features, *(round(v[c], 4) for c in ("total_price", "qty") for v in (p.scaler.mean, p.scaler.scale)))
            for f, p in enumerate(preps.preps)]
    return spark.createDataFrame(rows, "fold int, n_fit long, n_held_out long, n_synthetic long, n_features int, price_mean double, price_std double, qty_mean double, qty_std double")


@query("l8_learning_curves_regression")
def _l8_reg(spark, sf):
    x, _ = _frames(spark, sf)
    train = x.where(F.col("split") == "train")
    model = M.linear_regression(train, "ridge", alpha=1.0).fit(train)
    return M.loss_curve(model, "regression:ridge")
