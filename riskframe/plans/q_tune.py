"""Catalog entries for grids, cross-validation and result analysis (G*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import metrics as V
from riskframe.operators import split as SPL
from riskframe.operators import tune as G
from riskframe.plans.catalog import SEED, query, split_apps
from riskframe.session import checkpoint

# The scorer grid (nested-loop order, last parameter fastest).
GRID = {"threshold": [0.3, 0.4, 0.5, 0.6], "w_bal": [0, 5, 10, 20], "w_qty": ["0.01", "0.02", "0.04"],
        "discount": [None, "on"]}
SCORER_PARAMS = ("w_bal", "w_qty", "discount")


def _z(w_bal, w_qty, disc_on) -> F.Column:
    """Scorer family in exact decimals (M12 with tunable terms)."""
    d = lambda v, p, s: F.lit(str(v)).cast(f"decimal({p},{s})")
    z = (d("0.00001", 6, 5) * (F.col("total_price").cast("decimal(12,2)") - 250000)
         + d(w_bal, 4, 0) * d("0.00001", 6, 5) * (F.col("acct_balance").cast("decimal(12,2)") - 4500)
         + d(w_qty, 6, 4) * (F.col("qty").cast("decimal(12,2)") - 100))
    return z - 3 * F.col("max_discount").cast("decimal(6,2)") if disc_on else z


def score_grid(spark: SparkSession, rows: DataFrame, params: dict = GRID) -> DataFrame:
    """G1 + G2 for the scorer family: validation metrics of every config.

    Rows fan out once per distinct scorer (w_bal, w_qty, discount); the
    thresholds become conditional counts of one aggregation, so the fan-out
    is 24x here, not 96x.  The grid itself is collected
    (it is parameter-sized) to build the literal scorer list."""
    grid = G.param_grid(spark, params)
    scorers = sorted({tuple(r[p] for p in SCORER_PARAMS) for r in grid.collect()}, key=repr)
    arr = F.array(*[F.struct(F.lit(i).alias("scorer_id"), _z(wb, wq, disc == "on").alias("zd"))
                    for i, (wb, wq, disc) in enumerate(scorers)])
    fanned = checkpoint(rows.select("app_id", "class", F.explode(arr).alias("s")).select(
        "app_id", "class", "s.scorer_id", F.round(1 / (1 + F.exp(-F.col("s.zd").cast("double"))), 6).alias("p")))
    # (fanned is read by the count aggregation and by the AUC ranking)
    ths = list(params["threshold"])
    y, p = F.col("class"), F.col("p")
    cnt = []
    for i, t in enumerate(ths):
        hit = p > F.lit(float(t))
        cnt += [F.count_if((y == 2) & hit).alias(f"tp{i}"), F.count_if((y != 2) & hit).alias(f"fp{i}"),
                F.count_if((y == 2) & ~hit).alias(f"fn{i}"), F.count_if((y != 2) & ~hit).alias(f"tn{i}")]
    wide = fanned.groupBy("scorer_id").agg(*cnt)
    long = wide.select("scorer_id", F.explode(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), *[F.col(f"{c}{i}").alias(c) for c in ("tp", "fp", "fn", "tn")])
        for i, t in enumerate(ths)])).alias("c")).select("scorer_id", "c.*")
    auc = V.roc_auc(fanned, score="p", group_cols=["scorer_id"]).select("scorer_id", "roc_auc")
    sc_map = spark.createDataFrame([(i, *s) for i, s in enumerate(scorers)],
                                   "scorer_id int, w_bal int, w_qty string, discount string")
    # all four sides below are parameter-sized (<= configs rows)
    cfg = (grid.join(sc_map, [grid[c].eqNullSafe(sc_map[c]) for c in SCORER_PARAMS])
           .select("config_id", "n_configs", *[grid[c] for c in params], "scorer_id"))
    res = cfg.join(long, ["scorer_id", "threshold"]).join(auc, "scorer_id")
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    r = lambda c, name: F.round(c, 6).alias(name)
    return res.select("config_id", "n_configs", *params,
                      r((tp + tn) / (tp + fp + fn + tn), "val_accuracy"),
                      r(V._ratio(tp, tp + fp), "val_precision"), r(V._ratio(tp, tp + fn), "val_recall"),
                      r(V._ratio(2 * tp, 2 * tp + fp + fn), "val_f1"), F.col("roc_auc").alias("val_roc_auc"))


def grid_results(spark, sf):
    val = split_apps(spark, sf).where(F.col("split") == "val")
    return score_grid(spark, val)


PARAMS = list(GRID)


@query("g1_grid_results")
def _g1(spark, sf):
    return grid_results(spark, sf)


@query("g4_best_config")
def _g4(spark, sf):
    return G.best_config(grid_results(spark, sf), "val_f1")


@query("g5_top10")
def _g5(spark, sf):
    return G.top_k(grid_results(spark, sf), "val_f1", 10)


@query("g5_bottom10")
def _g5b(spark, sf):
    return G.top_k(grid_results(spark, sf), "val_f1", 10, ascending=True)


@query("g6_param_impact")
def _g6(spark, sf):
    return G.param_impact(grid_results(spark, sf), PARAMS, "val_f1", keep_null=True)


@query("g6_param_impact_drop_null")
def _g6b(spark, sf):
    return G.param_impact(grid_results(spark, sf), PARAMS, "val_f1", keep_null=False)


@query("g7_mean_by_key")
def _g7(spark, sf):
    return G.mean_by(grid_results(spark, sf), ["discount"], ["val_accuracy", "val_f1", "val_roc_auc"])


@query("g8_right_closed_bins")
def _g8(spark, sf):
    res = grid_results(spark, sf).withColumn("balance_units", F.col("w_bal") * 10)
    # The bin edges
    return G.binned_summary(res, "balance_units", [0, 50, 100, 150, 300], "val_f1")


@query("g9_banded_mean")
def _g9(spark, sf):
    t = F.col("threshold")
    band = F.when(t <= 0.3, "strong").when(t >= 0.6, "weak").otherwise("moderate")
    return G.banded_mean(grid_results(spark, sf), band, ["val_accuracy", "val_f1"])


@query("g10_tied_at_best")
def _g10(spark, sf):
    return G.tied_at_best(grid_results(spark, sf), "val_roc_auc", "config_id")


# ---------------------------------------------------------------- cross-validation (M12 family)
# Three named members of the scorer family compared by CV.
CV_MODELS = {"base": (10, "0.02", True, 0.5), "low_threshold": (10, "0.02", True, 0.4),
             "no_balance": (0, "0.02", True, 0.5)}


def cv_per_fold(spark, sf):
    """Per (model, fold) metrics on the held-out fold of a 5-fold split of
    the pooled train+val rows (the scorers have no fitted state)."""
    pool = SPL.pool(split_apps(spark, sf))
    folds = SPL.stratified_folds(pool, "app_id", "class", k=5, seed=SEED)
    arr = F.array(*[F.struct(F.lit(m).alias("model"), _z(wb, wq, d).alias("zd"), F.lit(t).alias("t"))
                    for m, (wb, wq, d, t) in CV_MODELS.items()])
    pred = folds.select("app_id", "class", "fold", F.explode(arr).alias("m")).select(
        "app_id", "class", "fold", "m.model", F.round(1 / (1 + F.exp(-F.col("m.zd").cast("double"))), 6).alias("p"),
        "m.t")
    pred = checkpoint(pred.withColumn("yhat", F.when(F.col("p") > F.col("t"), 2).otherwise(1)))
    g = ["model", "fold"]
    cls = V.classification_metrics(pred, group_cols=g, digits=12)
    auc = V.roc_auc(pred, group_cols=g, digits=12).select(*g, "roc_auc")
    return cls.join(auc, g).select(*g, "accuracy", F.col("precision_pos2").alias("precision"),
                                   F.col("recall_pos2").alias("recall"), F.col("f1_pos2").alias("f1"), "roc_auc")


CV_METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]


@query("g12_cv_summary")
def _g12(spark, sf):
    return G.fold_summary(cv_per_fold(spark, sf), ["model"], CV_METRICS)


@query("g13_cv_ranking")
def _g13(spark, sf):
    s = G.fold_summary(cv_per_fold(spark, sf), ["model"], ["accuracy"])
    return G.competition_rank(s.select("model", F.round("mean_accuracy", 4).alias("mean_test_score"),
                                       F.round("std_accuracy", 4).alias("std_test_score")),
                              "mean_test_score", "model", "rank_test_score")


@query("g14_winner_per_metric")
def _g14(spark, sf):
    s = G.fold_summary(cv_per_fold(spark, sf), ["model"], CV_METRICS)
    long = s.select("model", *[F.col(f"mean_{m}").alias(m) for m in CV_METRICS]).unpivot(
        ["model"], CV_METRICS, "metric", "mean")
    return G.winner_per_metric(long)



# ---------------------------------------------------------------- E6 / E7 on the grid results
from riskframe.functions import exprs as X  # noqa: E402

# The reference configuration the tuned grid is compared with.
BASELINE_CONFIG = {"threshold": 0.5, "w_bal": 10, "w_qty": "0.02", "discount": "on"}


@query("e6_round_metrics")
def _e6(spark, sf):
    from riskframe.sources.tables import scored_models
    m = V.classification_metrics(scored_models(spark, sf, n_models=8), group_cols=["config_id"], digits=12)
    return X.round_all(m, 4)


@query("e7_relative_improvement")
def _e7(spark, sf):
    res = grid_results(spark, sf)
    is_base = F.lit(True)
    for k, v in BASELINE_CONFIG.items():
        is_base = is_base & (F.col(k) == F.lit(v))
    metrics = ["val_accuracy", "val_f1", "val_roc_auc"]
    agg = res.agg(*[F.max(F.when(is_base, F.col(m))).alias(f"base_{m}") for m in metrics],
                  *[F.max(m).alias(f"best_{m}") for m in metrics])
    rows = []
    for m in metrics:
        pct, text = X.relative_improvement(F.col(f"base_{m}"), F.col(f"best_{m}"), lower_is_better=False)
        rows.append(F.struct(F.lit(m).alias("metric"), F.col(f"base_{m}").alias("base"),
                             F.col(f"best_{m}").alias("best"), pct.alias("pct_change"), text.alias("verdict")))
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
