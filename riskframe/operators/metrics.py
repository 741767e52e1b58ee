"""Evaluation metrics over a predictions table.

A predictions table has one row per (model, row): the true label, the hard
prediction, a score and optional group columns (``config_id``, ``split``...).
Every metric is an aggregation keyed by the group columns, so scoring many
models costs one scan and one (partial + final) aggregation, not one job per
model.  Counts use ``count_if`` and ratios ``try_divide`` (ANSI-safe,
``zero_division=0``).  Rank-based metrics (AUC, bands) first collapse rows
to distinct scores and then use the chunked running sums of
``functions.ranking`` - no window ever holds a whole model in one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.ranking import running_totals

# The misclassification cost matrix of the credit data
# documentation, (actual, predicted) -> cost.  Good=1, bad=2; calling a bad
# applicant good costs 5, refusing a good applicant costs 1.
DEFAULT_COSTS = {(1, 1): 0.0, (1, 2): 1.0, (2, 1): 5.0, (2, 2): 0.0}


def _g(group_cols: Sequence[str]) -> list[str]:
    return list(group_cols)


def _agg(df: DataFrame, group_cols: Sequence[str], *exprs: Column) -> DataFrame:
    return df.groupBy(*group_cols).agg(*exprs) if group_cols else df.agg(*exprs)


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


# ---------------------------------------------------------------- M12 / M13
def linear_score(coefs: Mapping[str, object], intercept: object = 0, decimal: str | None = None) -> Column:
    """``intercept + sum(w_f * x_f)`` as one projection expression.

    The coefficient table is a handful of rows (one per feature); it is
    applied as literals inside whole-stage codegen, which beats the unpivot /
    join / regroup form (that would shuffle every scored row).  With
    ``decimal`` (e.g. ``"decimal(12,2)"``) features and weights are exact
    decimals, so the score is bit-identical in every engine.
    """
    def lit(v):
        return F.lit(f"{float(v):.10f}").cast("decimal(20,10)") if decimal else F.lit(float(v))

    def x(c):
        return F.col(c).cast(decimal) if decimal else F.col(c).cast("double")
    z = lit(intercept)
    for f, w in coefs.items():
        z = z + lit(w) * x(f)
    return z


def coefficient_table(spark, coefs: Mapping[str, object], intercept: object = 0) -> DataFrame:
    """The coefficient table ``(feature, weight)`` incl. the ``(intercept)`` row."""
    rows = [("(intercept)", float(intercept))] + [(f, float(w)) for f, w in coefs.items()]
    return spark.createDataFrame(rows, "feature string, weight double")


def collect_coefficients(table: DataFrame) -> tuple[dict[str, float], float]:
    """A fitted coefficient table on the driver; the caller bounds its size."""
    rows = table.collect()
    b = sum(r["weight"] for r in rows if r["feature"] == "(intercept)")
    return {r["feature"]: r["weight"] for r in rows if r["feature"] != "(intercept)"}, b


def score_by_join(df: DataFrame, key: str, coefs: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """M12 for a coefficient table too large to inline: features go long
    (``unpivot``), join the ``(feature, weight)`` table on ``feature`` (a
    shuffle join - no size assumption on either side) and sum per row;
    ``(key, z)`` with the intercept added.  Rows whose features are all
    NULL keep the intercept."""
    feats = list(features) if features is not None else [c for c in df.columns if c != key]
    long = (df.select(key, *[F.col(c).cast("double").alias(c) for c in feats])
            .unpivot([key], feats, "feature", "x").where(F.col("x").isNotNull() & (F.col("x") != 0)))
    w = coefs.where(F.col("feature") != "(intercept)")
    b = coefs.where(F.col("feature") == "(intercept)").agg(F.sum("weight")).first()[0] or 0.0   # one scalar
    part = long.join(w, "feature").groupBy(key).agg(F.sum(F.col("x") * F.col("weight")).alias("_s"))
    return (df.select(key).join(part, key, "left")
            .select(key, (F.coalesce(F.col("_s"), F.lit(0.0)) + F.lit(float(b))).alias("z")))


def score_linear(df: DataFrame, key: str, coefs: DataFrame, max_inline: int = 10_000) -> DataFrame:
    """M12 with a size check: up to ``max_inline`` coefficients are applied
    as one projection (no shuffle); beyond that the join form is used."""
    n = coefs.count()
    if n - 1 <= max_inline:
        w, b = collect_coefficients(coefs)
        return df.select(key, linear_score(w, b).alias("z"))
    return score_by_join(df, key, coefs)


def trend_line(df: DataFrame, y: str, x: str, group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Least-squares line ``y ~ a + b x`` (``polyfit(x, y, 1)``)."""
    return _agg(df, group_cols,
                F.round(F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")), digits).alias("slope"),
                F.round(F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")), digits).alias("intercept"),
                F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- V1-V4
def confusion_long(pred: DataFrame, y: str = "class", yhat: str = "yhat", classes: Sequence[int] = (1, 2),
                   group_cols: Sequence[str] = ()) -> DataFrame:
    """V2: full confusion grid (zero cells included), one row per
    (group, actual, predicted) - one aggregation with a count per cell."""
    cells = [(a, b) for a in classes for b in classes]
    wide = _agg(pred, group_cols, *[F.count_if((F.col(y) == a) & (F.col(yhat) == b)).alias(f"c_{a}_{b}")
                                    for a, b in cells])
    arr = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c_{a}_{b}").alias("n"))
                    for a, b in cells])
    return wide.select(*_g(group_cols), F.explode(arr).alias("c")).select(*_g(group_cols), "c.actual", "c.predicted", "c.n")


def confusion_matrix(pred: DataFrame, y: str = "class", yhat: str = "yhat", classes: Sequence[int] = (1, 2),
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """V2, matrix form: rows = true class, one column per predicted class."""
    long = confusion_long(pred, y, yhat, classes, group_cols)
    return (long.groupBy(*_g(group_cols), "actual").pivot("predicted", list(classes)).agg(F.first("n"))
            .select(*_g(group_cols), "actual", *[F.col(str(c)).alias(f"pred_{c}") for c in classes]))


def classification_metrics(pred: DataFrame, y: str = "class", yhat: str = "yhat", positive: int = 2,
                           negative: int = 1, group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """V1, V3, V4 for every group in one aggregation.

    Names carry the averaging: ``f1_pos2`` (positive class), ``f1_pos1``,
    ``f1_weighted`` (support-weighted over both classes).
    """
    yt, yp = F.col(y), F.col(yhat)
    agg = _agg(pred, group_cols,
               F.count(F.lit(1)).alias("n"),
               F.count_if(yt == yp).alias("n_correct"),
               F.count_if((yt == positive) & (yp == positive)).alias("tp"),
               F.count_if((yt != positive) & (yp == positive)).alias("fp"),
               F.count_if((yt == positive) & (yp != positive)).alias("fn"),
               F.count_if((yt != positive) & (yp != positive)).alias("tn"))
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n"))
    f1_pos = _ratio(2 * tp, 2 * tp + fp + fn)
    f1_neg = _ratio(2 * tn, 2 * tn + fn + fp)        # the negative class seen as positive
    support_pos, support_neg = tp + fn, tn + fp
    f1_w = _ratio(f1_pos * support_pos + f1_neg * support_neg, n)
    r = lambda c, name: F.round(c, digits).alias(name)
    return agg.select(*_g(group_cols), "n", "tp", "fp", "fn", "tn",
                      r(_ratio(F.col("n_correct"), n), "accuracy"),
                      r(_ratio(tp, tp + fp), f"precision_pos{positive}"),
                      r(_ratio(tp, tp + fn), f"recall_pos{positive}"),
                      r(f1_pos, f"f1_pos{positive}"),
                      r(f1_neg, f"f1_pos{negative}"),
                      r(f1_w, "f1_weighted"))


# ---------------------------------------------------------------- V5
def roc_auc(pred: DataFrame, y: str = "class", score: str = "p", positive: int = 2,
            group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """V5: exact ROC-AUC with ties counted one half (Mann-Whitney mid-ranks).

    Rows collapse to one per distinct (group, score) with positive/negative
    counts (map-side combined, so a score shared by a third of the rows is
    one row).  The number of negatives strictly below each score is a
    chunked running sum, then
    ``AUC = sum(pos_s * (neg_below_s + neg_s / 2)) / (P * N)``.
    NULL when a group has only one class.
    """
    g = _g(group_cols)
    per_score = (pred.where(F.col(score).isNotNull())
                 .groupBy(*g, F.col(score).alias("_s"))
                 .agg(F.count_if(F.col(y) == positive).alias("_pos"),
                      F.count_if(F.col(y) != positive).alias("_neg")))
    rt = running_totals(per_score, g, ["_s"], "_neg")
    part = F.col("_pos") * (F.col("_before") + F.col("_neg") * 0.5)
    out = _agg(rt, g, F.sum(part).alias("_num"), F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"))
    auc = F.try_divide(F.col("_num"), F.col("n_pos").cast("double") * F.col("n_neg").cast("double"))
    return out.select(*g, "n_pos", "n_neg", F.round(auc, digits).alias("roc_auc"))


# ---------------------------------------------------------------- V6-V9
def regression_metrics(pred: DataFrame, y: str, yhat: str, group_cols: Sequence[str] = (),
                       digits: int = 6) -> DataFrame:
    """V6 MAE / RMSE and V7 R^2 = 1 - SSE / SST, one aggregation per group."""
    yt, yp = F.col(y).cast("double"), F.col(yhat).cast("double")
    agg = _agg(pred, group_cols, F.count(F.lit(1)).alias("n"), F.avg(F.abs(yt - yp)).alias("_mae"),
               F.avg(F.pow(yt - yp, 2)).alias("_mse"), F.var_pop(yt).alias("_vy"))
    r2 = F.when(F.col("_vy") > 0, 1 - F.col("_mse") / F.col("_vy"))
    return agg.select(*_g(group_cols), "n", F.round("_mae", digits).alias("mae"),
                      F.round(F.sqrt("_mse"), digits).alias("rmse"), F.round(r2, digits).alias("r2"))


def residuals(pred: DataFrame, key: str, y: str, yhat: str, digits: int = 6) -> DataFrame:
    """V8: residual rows ``y - yhat``."""
    return pred.select(key, F.col(y).cast("double").alias("y"), F.col(yhat).cast("double").alias("yhat"),
                       F.round(F.col(y).cast("double") - F.col(yhat).cast("double"), digits).alias("resid"))


def residual_summary(res: DataFrame, group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """V8: mean and population standard deviation of the residuals."""
    return _agg(res, group_cols, F.count(F.lit(1)).alias("n"), F.round(F.avg("resid"), digits).alias("mean"),
                F.round(F.stddev_pop("resid"), digits).alias("sd"))


def normal_overlay(res: DataFrame, bins: int = 30, points: int = 100, digits: int = 6) -> DataFrame:
    """V9: normal density at ``points`` evenly spaced residual values, scaled
    to histogram counts (``pdf * n * range / bins``)."""
    st = res.agg(F.count(F.lit(1)).alias("n"), F.avg("resid").alias("mu"), F.stddev_pop("resid").alias("sd"),
                 F.min("resid").alias("lo"), F.max("resid").alias("hi"))
    k = F.col("k")
    x = F.col("lo") + k * (F.col("hi") - F.col("lo")) / (points - 1)
    z = (x - F.col("mu")) / F.col("sd")
    pdf = F.exp(-z * z / 2) / (F.col("sd") * math.sqrt(2 * math.pi))
    dens = pdf * F.col("n") * (F.col("hi") - F.col("lo")) / bins
    return (st.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("k"))
            .select(k.cast("int").alias("point"), F.round(x, digits).alias("x"),
                    F.round(F.when(F.col("sd") > 0, dens), digits).alias("density")))


# ---------------------------------------------------------------- V10 / V11
def coefficient_importance(coefs: DataFrame, digits: int = 6) -> DataFrame:
    """|w| per feature, ranked (ties by name); intercept excluded."""
    c = coefs.where(F.col("feature") != "(intercept)")
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature")   # one row per feature
    return (c.select("feature", F.round(F.abs("weight"), digits).alias("importance"))
            .withColumn("rank", F.row_number().over(w)))


# ---------------------------------------------------------------- V13-V15
def cost_table(spark, costs: Mapping[tuple[int, int], float] = DEFAULT_COSTS) -> DataFrame:
    return spark.createDataFrame([(a, p, float(c)) for (a, p), c in costs.items()],
                                 "actual int, predicted int, cost double")


def expected_cost(pred: DataFrame, costs: DataFrame, y: str = "class", yhat: str = "yhat",
                  classes: Sequence[int] = (1, 2), group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Confusion counts joined to the cost matrix -> total and per-row cost.

    The join is between two tiny tables (4 cells per group x 4 costs)."""
    g = _g(group_cols)
    cm = confusion_long(pred, y, yhat, classes, g)
    j = cm.join(F.broadcast(costs), ["actual", "predicted"], "left")   # k*k rows
    return (j.groupBy(*g).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("cost", F.lit(0.0))).alias("_c"))
            .select(*g, "n", F.round("_c", digits).alias("total_cost"),
                    F.round(F.col("_c") / F.col("n"), digits).alias("cost_per_row")))


def threshold_sweep(pred: DataFrame, thresholds: Sequence[float], y: str = "class", score: str = "p",
                    positive: int = 2, fn_cost: float = 5.0, fp_cost: float = 1.0,
                    group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """FN / FP / cost at each threshold (``p > t`` is positive) and the
    cost-minimising threshold (ties: the higher threshold).

    One scan: two conditional counts per threshold in a single aggregation,
    then an unpivot of the tiny result - the thresholds are never joined to
    the rows."""
    g = _g(group_cols)
    yt, s = F.col(y), F.col(score)
    exprs = []
    for i, t in enumerate(thresholds):
        exprs += [F.count_if((yt == positive) & ~(s > F.lit(float(t)))).alias(f"fn{i}"),
                  F.count_if((yt != positive) & (s > F.lit(float(t)))).alias(f"fp{i}")]
    wide = _agg(pred, g, *exprs)
    arr = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"fn{i}").alias("fn"),
                             F.col(f"fp{i}").alias("fp")) for i, t in enumerate(thresholds)])
    long = wide.select(*g, F.explode(arr).alias("c")).select(*g, "c.threshold", "c.fn", "c.fp")
    long = long.withColumn("cost", F.round(F.col("fn") * fn_cost + F.col("fp") * fp_cost, digits))
    best = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))   # len(thresholds) rows per group
    rk = F.row_number().over(best.orderBy("cost", F.desc("threshold")))
    return long.withColumn("is_best", rk == 1)


def breusch_pagan(res: DataFrame, fitted: str = "yhat", group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """LM statistic ``n * R^2`` of resid^2 regressed on the fitted value."""
    r2 = F.regr_r2(F.pow(F.col("resid"), 2), F.col(fitted))
    return _agg(res, group_cols, F.count(F.lit(1)).alias("n"), F.round(F.count(F.lit(1)) * r2, digits).alias("lm_stat"),
                F.round(r2, digits).alias("r2_aux"))


def ntile_bands(df: DataFrame, order_col: str, key: str, bands: int, out: str = "band") -> DataFrame:
    """``ntile(bands) over (order by order_col, key)`` from a chunked running
    count (no one-task window): first ``n % bands`` bands get one extra row."""
    rt = running_totals(df.withColumn("_one", F.lit(1).cast("long")), [], [order_col, key], "_one")
    n, pos = F.col("_total"), F.col("_before")
    q, r = F.floor(n / bands), n % bands
    big = r * (q + 1)
    band = F.when(pos < big, F.floor(pos / (q + 1)) + 1).otherwise(r + F.floor((pos - big) / q) + 1)
    return rt.withColumn(out, band.cast("int")).drop("_one", "_before", "_total")


def spread_by_band(res: DataFrame, fitted: str = "yhat", key: str = "key", bands: int = 5,
                   digits: int = 6) -> DataFrame:
    """Residual sd per fitted-value band (equal-count bands)."""
    b = ntile_bands(res, fitted, key, bands)
    return (b.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.round(F.min(fitted), digits).alias("fitted_lo"),
                                  F.round(F.max(fitted), digits).alias("fitted_hi"),
                                  F.round(F.stddev_samp("resid"), digits).alias("resid_sd")))


def permutation_importance(df: DataFrame, key: str, label: str, coefs: Mapping[str, object], intercept: object,
                           positive: int = 2, negative: int = 1, repeats: int = 10, seed: int = 42,
                           top: int = 15, decimal: str = "decimal(12,2)", digits: int = 6) -> DataFrame:
    """Mean accuracy drop when one feature is shuffled, ``repeats``
    seeded shuffles per feature, top ``top`` features.

    The model is linear (M12), so a shuffled score is ``z - w x_i + w x_j``,
    in exact decimals: only the shuffled term travels.  A shuffle pairs the row
    at position ``p`` of one md5 order with the row at position ``p`` of a
    second one, i.e. a uniformly random permutation per (feature, repeat),
    identical on every engine and under re-execution.  All shuffles are made
    at once, in packed chunks (``operators/shuffles.py``).
    """
    from riskframe.operators.shuffles import shuffle_hits

    def lit(v):
        return F.lit(f"{float(v):.10f}").cast("decimal(20,10)")
    terms = {f: lit(w) * F.col(f).cast(decimal) for f, w in coefs.items()}
    hits = shuffle_hits(df, key, label, terms, lit(intercept), linear_score(coefs, intercept, decimal), positive, negative, repeats, seed)
    # every (feature, repeat) group holds all rows, so the base accuracy is
    # the same aggregate over the unshuffled prediction - no join needed
    drops = hits.select("feature", "repeat", (F.try_divide("base", "n") - F.try_divide("new", "n")).alias("drop"))
    imp = drops.groupBy("feature").agg(F.avg("drop").alias("_m"), F.stddev_pop("drop").alias("_s"))
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("_m"), "feature")   # one row per feature
    return (imp.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
            .select("rank", "feature", F.round("_m", digits).alias("importance_mean"),
                    F.round("_s", digits).alias("importance_sd")))
