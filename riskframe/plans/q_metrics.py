"""Catalog entries for scoring and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import metrics as V
from riskframe.operators import profile as P
from riskframe.plans.catalog import query, split_apps
from riskframe.session import checkpoint
from riskframe.sources.tables import applications, scored

# The linear model used as the deterministic scorer (M12);
# weights on raw features, intercept centres them at typical values.
M12_COEFS = {"total_price": "0.00001", "acct_balance": "0.0001", "qty": "0.02", "max_discount": "-3"}
M12_INTERCEPT = "-4.95"
THRESHOLDS = [0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2]


def scored_split(spark, sf):
    """Deterministic predictions with the split of every row."""
    return scored(spark, sf, apps=split_apps(spark, sf), keep=("split",))


def reg_residuals(spark, sf):
    """Regression view: label as a number vs ``reg_pred``."""
    return V.residuals(scored(spark, sf), "app_id", "class", "reg_pred")


def m12_model(spark, sf):
    """M12 applied through its coefficient table (a fixed list of terms)."""
    return V.collect_coefficients(V.coefficient_table(spark, M12_COEFS, M12_INTERCEPT))


@query("m12_linear_score")
def _m12(spark, sf):
    coefs, b = m12_model(spark, sf)
    z = V.linear_score(coefs, b, decimal="decimal(12,2)")
    a = applications(spark, sf).select("app_id", "class", z.alias("zd"))
    zd = F.col("zd").cast("double")
    return a.select("app_id", "class", zd.alias("z"), F.round(1 / (1 + F.exp(-zd)), 6).alias("p"),
                    F.when(F.col("zd") > 0, 2).otherwise(1).alias("yhat"))


@query("m13_residual_trend")
def _m13(spark, sf):
    return V.trend_line(reg_residuals(spark, sf), "resid", "yhat")


@query("v1_accuracy")
def _v1(spark, sf):
    return V.classification_metrics(scored_split(spark, sf), group_cols=["split"]).select("split", "n", "accuracy")


@query("v2_confusion_matrix")
def _v2(spark, sf):
    return V.confusion_matrix(scored_split(spark, sf), group_cols=["split"])


@query("v3_precision_recall_f1")
def _v3(spark, sf):
    return V.classification_metrics(scored_split(spark, sf), group_cols=["split"]).select(
        "split", "tp", "fp", "fn", "precision_pos2", "recall_pos2", "f1_pos2")


@query("v4_weighted_f1")
def _v4(spark, sf):
    return V.classification_metrics(scored_split(spark, sf), group_cols=["split"]).select(
        "split", "f1_pos1", "f1_pos2", "f1_weighted")


@query("v5_roc_auc")
def _v5(spark, sf):
    return V.roc_auc(scored_split(spark, sf), group_cols=["split"])


@query("v6_mae_rmse")
def _v6(spark, sf):
    return V.regression_metrics(scored_split(spark, sf), "class", "reg_pred", ["split"]).select(
        "split", "n", "mae", "rmse")


@query("v7_r2")
def _v7(spark, sf):
    return V.regression_metrics(scored_split(spark, sf), "class", "reg_pred", ["split"]).select("split", "r2")


@query("v8_residuals")
def _v8(spark, sf):
    return reg_residuals(spark, sf)


@query("v8_residual_summary")
def _v8b(spark, sf):
    return V.residual_summary(reg_residuals(spark, sf))


@query("v9_residual_histogram")
def _v9(spark, sf):
    return P.histogram(reg_residuals(spark, sf), ["resid"], bins=30, digits=6)


@query("v9_normal_overlay")
def _v9b(spark, sf):
    return V.normal_overlay(reg_residuals(spark, sf), bins=30, points=100)


@query("v10_permutation_importance")
def _v10(spark, sf):
    test = split_apps(spark, sf).where(F.col("split") == "test")
    coefs, b = m12_model(spark, sf)
    return V.permutation_importance(test, "app_id", "class", coefs, b, repeats=10, seed=42, top=15)


@query("v11_coefficient_importance")
def _v11(spark, sf):
    # |w| in standardised units: the raw weight times the population sd of
    # its feature on the training rows (what |coef| of a model fitted on
    # scaled inputs measures).
    train = split_apps(spark, sf).where(F.col("split") == "train")
    feats = list(M12_COEFS)
    sd = train.agg(*[F.stddev_pop(F.col(f).cast("double")).alias(f) for f in feats])
    long = sd.unpivot([], feats, "feature", "sd")
    w = F.create_map(*[x for f in feats for x in (F.lit(f), F.lit(float(M12_COEFS[f])))])
    return V.coefficient_importance(long.select("feature", (w[F.col("feature")] * F.col("sd")).alias("weight")))


@query("v12_metrics_by_model")
def _v12(spark, sf):
    from riskframe.sources.tables import scored_models
    pred = checkpoint(scored_models(spark, sf, n_models=8))     # read by both aggregations
    cls = V.classification_metrics(pred, group_cols=["config_id"])
    auc = V.roc_auc(pred, group_cols=["config_id"]).select("config_id", "roc_auc")
    return cls.join(auc, "config_id").drop("tp", "fp", "fn", "tn")   # one row per model on each side


@query("v13_expected_cost")
def _v13(spark, sf):
    return V.expected_cost(scored_split(spark, sf), V.cost_table(spark), group_cols=["split"])


@query("v14_threshold_sweep")
def _v14(spark, sf):
    return V.threshold_sweep(scored_split(spark, sf), THRESHOLDS, group_cols=["split"])


@query("v15_breusch_pagan")
def _v15(spark, sf):
    return V.breusch_pagan(reg_residuals(spark, sf))


@query("v15_spread_by_band")
def _v15b(spark, sf):
    return V.spread_by_band(reg_residuals(spark, sf), key="app_id", bands=5)
