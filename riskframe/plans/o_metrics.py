"""DuckDB twins of the scoring / metrics queries."""

from __future__ import annotations

from riskframe.plans.oracle import ORACLE, _hash, split_cte
from riskframe.plans.views_sql import SCORED, with_views

SCORED_SP = (SCORED.replace("SELECT app_id, class, CAST(zd", "SELECT app_id, class, split, CAST(zd")
             .replace("FROM (SELECT app_id, class,", "FROM (SELECT app_id, class, split,")
             .replace("FROM apps) q", "FROM sp) q"))
SC = split_cte() + f"\n, sc AS ({SCORED_SP})"
RES = ", res AS (SELECT app_id, CAST(class AS DOUBLE) AS y, reg_pred AS yhat, round(CAST(class AS DOUBLE) - reg_pred, 6) AS resid FROM scored)"

Z_M12 = ("CAST('-4.95' AS DECIMAL(20,10)) + CAST('0.00001' AS DECIMAL(20,10)) * CAST(total_price AS DECIMAL(12,2))"
         " + CAST('0.0001' AS DECIMAL(20,10)) * CAST(acct_balance AS DECIMAL(12,2))"
         " + CAST('0.02' AS DECIMAL(20,10)) * CAST(qty AS DECIMAL(12,2))"
         " + CAST('-3' AS DECIMAL(20,10)) * CAST(max_discount AS DECIMAL(12,2))")

CLS = """SELECT split, count(*) AS n,
       count(*) FILTER (WHERE class = 2 AND yhat = 2) AS tp, count(*) FILTER (WHERE class <> 2 AND yhat = 2) AS fp,
       count(*) FILTER (WHERE class = 2 AND yhat <> 2) AS fn, count(*) FILTER (WHERE class <> 2 AND yhat <> 2) AS tn,
       count(*) FILTER (WHERE class = yhat) AS n_correct
FROM {src} GROUP BY split"""


def _z(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0), 0.0)"


ORACLE["m12_linear_score"] = with_views(f"""
SELECT app_id, class, CAST(zd AS DOUBLE) AS z, round(1 / (1 + exp(-CAST(zd AS DOUBLE))), 6) AS p,
       CASE WHEN zd > 0 THEN 2 ELSE 1 END AS yhat
FROM (SELECT app_id, class, {Z_M12} AS zd FROM apps) q""")

ORACLE["m13_residual_trend"] = with_views(RES + """
SELECT round(regr_slope(resid, yhat), 6) AS slope, round(regr_intercept(resid, yhat), 6) AS intercept, count(*) AS n
FROM res""", scored=True)

ORACLE["v1_accuracy"] = with_views(SC + f", m AS ({CLS.format(src='sc')})\n"
                                   f"SELECT split, n, round({_z('n_correct', 'n')}, 6) AS accuracy FROM m")

ORACLE["v2_confusion_matrix"] = with_views(SC + """
, cells AS (SELECT split, a.actual, count(*) FILTER (WHERE class = a.actual AND yhat = 1) AS pred_1,
                   count(*) FILTER (WHERE class = a.actual AND yhat = 2) AS pred_2
            FROM sc, (VALUES (1), (2)) a(actual) GROUP BY split, a.actual)
SELECT split, CAST(actual AS INTEGER) AS actual, pred_1, pred_2 FROM cells""")

ORACLE["v3_precision_recall_f1"] = with_views(SC + f", m AS ({CLS.format(src='sc')})\n" + f"""
SELECT split, tp, fp, fn, round({_z('tp', 'tp + fp')}, 6) AS precision_pos2,
       round({_z('tp', 'tp + fn')}, 6) AS recall_pos2, round({_z('2 * tp', '2 * tp + fp + fn')}, 6) AS f1_pos2
FROM m""")

ORACLE["v4_weighted_f1"] = with_views(SC + f", m AS ({CLS.format(src='sc')})\n" + f"""
, f AS (SELECT *, {_z('2 * tp', '2 * tp + fp + fn')} AS f2, {_z('2 * tn', '2 * tn + fn + fp')} AS f1 FROM m)
SELECT split, round(f1, 6) AS f1_pos1, round(f2, 6) AS f1_pos2,
       round({_z('f2 * (tp + fn) + f1 * (tn + fp)', 'n')}, 6) AS f1_weighted
FROM f""")

ORACLE["v5_roc_auc"] = with_views(SC + """
, r AS (SELECT split, class, rank() OVER (PARTITION BY split ORDER BY p) AS rk,
               count(*) OVER (PARTITION BY split, p) AS ties FROM sc),
a AS (SELECT split, count(*) FILTER (WHERE class = 2) AS n_pos, count(*) FILTER (WHERE class <> 2) AS n_neg,
             sum(CASE WHEN class = 2 THEN rk + (ties - 1) / 2.0 END) AS rsum FROM r GROUP BY split)
SELECT split, n_pos, n_neg,
       round((rsum - n_pos * (n_pos + 1) / 2.0) / CAST(n_pos * n_neg AS DOUBLE), 6) AS roc_auc FROM a""")

_REG = """SELECT split, count(*) AS n, avg(abs(CAST(class AS DOUBLE) - reg_pred)) AS mae,
       avg(pow(CAST(class AS DOUBLE) - reg_pred, 2)) AS mse, var_pop(CAST(class AS DOUBLE)) AS vy FROM sc GROUP BY split"""

ORACLE["v6_mae_rmse"] = with_views(SC + f", m AS ({_REG})\n"
                                   "SELECT split, n, round(mae, 6) AS mae, round(sqrt(mse), 6) AS rmse FROM m")

ORACLE["v7_r2"] = with_views(SC + f", m AS ({_REG})\n"
                             "SELECT split, round(CASE WHEN vy > 0 THEN 1 - mse / vy END, 6) AS r2 FROM m")

ORACLE["v8_residuals"] = with_views(RES + "\nSELECT app_id, y, yhat, resid FROM res", scored=True)

ORACLE["v8_residual_summary"] = with_views(RES + """
SELECT count(*) AS n, round(avg(resid), 6) AS mean, round(stddev_pop(resid), 6) AS sd FROM res""", scored=True)

ORACLE["v9_residual_histogram"] = with_views(RES + """
, rng AS (SELECT 'resid' AS feature, min(resid) AS mn, max(resid) AS mx FROM res),
binned AS (SELECT CASE WHEN mx = mn THEN 1 ELSE least(CAST(floor((resid - mn) * 30 / (mx - mn)) AS INTEGER) + 1, 30) END AS bin
           FROM res, rng),
cnt AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin),
grid AS (SELECT feature, mn, mx, CAST(b AS INTEGER) AS bin FROM rng, range(1, 31) t(b) WHERE b = 1 OR mx > mn)
SELECT feature, g.bin, round(mn + (g.bin - 1) * CASE WHEN mx = mn THEN 0.0 ELSE (mx - mn) / 30 END, 6) AS lo,
       round(CASE WHEN mx = mn THEN mx ELSE mn + g.bin * ((mx - mn) / 30) END, 6) AS hi, coalesce(n, 0) AS n
FROM grid g LEFT JOIN cnt c ON g.bin = c.bin""", scored=True)

ORACLE["v9_normal_overlay"] = with_views(RES + """
, st AS (SELECT count(*) AS n, avg(resid) AS mu, stddev_pop(resid) AS sd, min(resid) AS lo, max(resid) AS hi FROM res),
pts AS (SELECT CAST(k AS INTEGER) AS point, lo + k * (hi - lo) / 99 AS x, n, mu, sd, lo, hi FROM st, range(0, 100) t(k))
SELECT point, round(x, 6) AS x,
       round(CASE WHEN sd > 0 THEN exp(-((x - mu) / sd) * ((x - mu) / sd) / 2) / (sd * sqrt(2 * pi())) * n * (hi - lo) / 30 END, 6)
         AS density
FROM pts""", scored=True)

_PI_FEATS = [("total_price", "0.00001"), ("acct_balance", "0.0001"), ("qty", "0.02"), ("max_discount", "-3")]
ORACLE["v10_permutation_importance"] = with_views(split_cte() + f"""
, base AS (SELECT app_id, class, {Z_M12} AS z, total_price, acct_balance, qty, max_discount FROM sp WHERE split = 'test'),
long AS (""" + "\nUNION ALL ".join(
    f"SELECT app_id, class, z, '{f}' AS feature, CAST('{w}' AS DECIMAL(20,10)) AS w, CAST({f} AS DECIMAL(12,2)) AS x FROM base"
    for f, w in _PI_FEATS) + f"""),
rep AS (SELECT l.*, CAST(r AS INTEGER) AS rpt FROM long l, range(1, 11) t(r)),
keyed AS (SELECT *, CAST(app_id AS VARCHAR) || '|' || feature || '|' || CAST(rpt AS VARCHAR) AS k FROM rep),
dst AS (SELECT *, row_number() OVER (PARTITION BY feature, rpt ORDER BY {_hash('k', 'dst42')}, k) AS pos FROM keyed),
src AS (SELECT feature, rpt, x AS x_new,
               row_number() OVER (PARTITION BY feature, rpt ORDER BY {_hash('k', 'src42')}, k) AS pos FROM keyed),
j AS (SELECT d.feature, d.rpt, d.class, d.z, d.z - d.w * d.x + d.w * s.x_new AS z_new
      FROM dst d JOIN src s ON d.feature = s.feature AND d.rpt = s.rpt AND d.pos = s.pos),
drops AS (SELECT feature, rpt,
                 avg(CASE WHEN (CASE WHEN z > 0 THEN 2 ELSE 1 END) = class THEN 1.0 ELSE 0.0 END)
                 - avg(CASE WHEN (CASE WHEN z_new > 0 THEN 2 ELSE 1 END) = class THEN 1.0 ELSE 0.0 END) AS dr
          FROM j GROUP BY feature, rpt),
imp AS (SELECT feature, avg(dr) AS m, stddev_pop(dr) AS s FROM drops GROUP BY feature)
SELECT CAST(row_number() OVER (ORDER BY m DESC, feature) AS INTEGER) AS rank, feature,
       round(m, 6) AS importance_mean, round(s, 6) AS importance_sd
FROM imp QUALIFY rank <= 15""")

ORACLE["v11_coefficient_importance"] = with_views(split_cte() + """
, sd AS (""" + "\nUNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({w} AS DOUBLE) * stddev_pop(CAST({f} AS DOUBLE)) AS weight FROM sp WHERE split = 'train'"
    for f, w in _PI_FEATS) + """)
SELECT feature, round(abs(weight), 6) AS importance,
       CAST(row_number() OVER (ORDER BY round(abs(weight), 6) DESC, feature) AS INTEGER) AS rank FROM sd""")

ORACLE["v12_metrics_by_model"] = with_views("""
, m AS (SELECT config_id, count(*) AS n,
       count(*) FILTER (WHERE class = 2 AND yhat = 2) AS tp, count(*) FILTER (WHERE class <> 2 AND yhat = 2) AS fp,
       count(*) FILTER (WHERE class = 2 AND yhat <> 2) AS fn, count(*) FILTER (WHERE class <> 2 AND yhat <> 2) AS tn,
       count(*) FILTER (WHERE class = yhat) AS n_correct FROM models GROUP BY config_id),
f AS (SELECT *, """ + f"{_z('2 * tp', '2 * tp + fp + fn')} AS f2, {_z('2 * tn', '2 * tn + fn + fp')} AS f1 FROM m)," + """
r AS (SELECT config_id, class, rank() OVER (PARTITION BY config_id ORDER BY p) AS rk,
             count(*) OVER (PARTITION BY config_id, p) AS ties FROM models),
a AS (SELECT config_id, count(*) FILTER (WHERE class = 2) AS n_pos, count(*) FILTER (WHERE class <> 2) AS n_neg,
             sum(CASE WHEN class = 2 THEN rk + (ties - 1) / 2.0 END) AS rsum FROM r GROUP BY config_id)
SELECT config_id, n, """ + f"""round({_z('n_correct', 'n')}, 6) AS accuracy,
       round({_z('tp', 'tp + fp')}, 6) AS precision_pos2, round({_z('tp', 'tp + fn')}, 6) AS recall_pos2,
       round(f2, 6) AS f1_pos2, round(f1, 6) AS f1_pos1, round({_z('f2 * (tp + fn) + f1 * (tn + fp)', 'n')}, 6) AS f1_weighted,
       round((rsum - n_pos * (n_pos + 1) / 2.0) / CAST(n_pos * n_neg AS DOUBLE), 6) AS roc_auc
FROM f JOIN a USING (config_id)""", models=8)

ORACLE["v13_expected_cost"] = with_views(SC + """
, costs AS (SELECT * FROM (VALUES (1, 1, 0.0), (1, 2, 1.0), (2, 1, 5.0), (2, 2, 0.0)) t(actual, predicted, cost))
SELECT split, count(*) AS n, round(sum(CAST(cost AS DOUBLE)), 6) AS total_cost,
       round(sum(CAST(cost AS DOUBLE)) / count(*), 6) AS cost_per_row
FROM sc JOIN costs ON costs.actual = sc.class AND costs.predicted = sc.yhat GROUP BY split""")

_TH = [0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2]
ORACLE["v14_threshold_sweep"] = with_views(SC + """
, th AS (SELECT * FROM (VALUES """ + ", ".join(f"({t!r})" for t in _TH) + """) t(threshold)),
c AS (SELECT split, CAST(threshold AS DOUBLE) AS threshold,
             count(*) FILTER (WHERE class = 2 AND NOT (p > threshold)) AS fn,
             count(*) FILTER (WHERE class <> 2 AND p > threshold) AS fp
      FROM sc, th GROUP BY split, threshold)
SELECT split, threshold, fn, fp, CAST(round(fn * 5.0 + fp * 1.0, 6) AS DOUBLE) AS cost,
       row_number() OVER (PARTITION BY split ORDER BY round(fn * 5.0 + fp * 1.0, 6), threshold DESC) = 1 AS is_best
FROM c""")

ORACLE["v15_breusch_pagan"] = with_views(RES + """
SELECT count(*) AS n, round(count(*) * regr_r2(resid * resid, yhat), 6) AS lm_stat,
       round(regr_r2(resid * resid, yhat), 6) AS r2_aux FROM res""", scored=True)

ORACLE["v15_spread_by_band"] = with_views(RES + """
, b AS (SELECT *, CAST(ntile(5) OVER (ORDER BY yhat, app_id) AS INTEGER) AS band FROM res)
SELECT band, count(*) AS n, round(min(yhat), 6) AS fitted_lo, round(max(yhat), 6) AS fitted_hi,
       round(stddev_samp(resid), 6) AS resid_sd FROM b GROUP BY band""", scored=True)
