"""DuckDB twins of the grid / cross-validation queries (G*)."""

from __future__ import annotations

from riskframe.plans.oracle import ORACLE, _hash, split_cte
from riskframe.plans.views_sql import with_views


def _zd(w_bal: str, w_qty: str, disc_on: str) -> str:
    return (f"CAST('0.00001' AS DECIMAL(6,5)) * (CAST(total_price AS DECIMAL(12,2)) - 250000)"
            f" + CAST(CAST({w_bal} AS VARCHAR) AS DECIMAL(4,0)) * CAST('0.00001' AS DECIMAL(6,5))"
            f" * (CAST(acct_balance AS DECIMAL(12,2)) - 4500)"
            f" + CAST({w_qty} AS DECIMAL(6,4)) * (CAST(qty AS DECIMAL(12,2)) - 100)"
            f" - CASE WHEN {disc_on} THEN 3 * CAST(max_discount AS DECIMAL(6,2)) ELSE 0 END")


_P = "round(1 / (1 + exp(-CAST(zd AS DOUBLE))), 6)"

RESULTS = split_cte() + f"""
, grid AS (SELECT CAST(((t.i * 4 + b.i) * 3 + q.i) * 2 + d.i + 1 AS INTEGER) AS config_id,
                  CAST(t.v AS DOUBLE) AS threshold, CAST(b.v AS INTEGER) AS w_bal, q.v AS w_qty, d.v AS discount
           FROM (VALUES (0, 0.3), (1, 0.4), (2, 0.5), (3, 0.6)) t(i, v),
                (VALUES (0, 0), (1, 5), (2, 10), (3, 20)) b(i, v),
                (VALUES (0, '0.01'), (1, '0.02'), (2, '0.04')) q(i, v),
                (VALUES (0, NULL::VARCHAR), (1, 'on')) d(i, v)),
val AS (SELECT * FROM sp WHERE split = 'val'),
scorers AS (SELECT DISTINCT w_bal, w_qty, discount FROM grid),
ps AS (SELECT w_bal, w_qty, discount, app_id, class, {_P} AS p
       FROM (SELECT s.w_bal, s.w_qty, s.discount, v.app_id, v.class,
                    {_zd('s.w_bal', 's.w_qty', "s.discount = 'on'")} AS zd
             FROM scorers s, val v) z),
cm AS (SELECT g.config_id, count(*) FILTER (WHERE class = 2 AND p > threshold) AS tp,
              count(*) FILTER (WHERE class <> 2 AND p > threshold) AS fp,
              count(*) FILTER (WHERE class = 2 AND NOT p > threshold) AS fn,
              count(*) FILTER (WHERE class <> 2 AND NOT p > threshold) AS tn
       FROM grid g JOIN ps ON g.w_bal = ps.w_bal AND g.w_qty = ps.w_qty AND g.discount IS NOT DISTINCT FROM ps.discount
       GROUP BY g.config_id),
rk AS (SELECT w_bal, w_qty, discount, class, rank() OVER (PARTITION BY w_bal, w_qty, discount ORDER BY p) AS r,
              count(*) OVER (PARTITION BY w_bal, w_qty, discount, p) AS ties FROM ps),
auc AS (SELECT w_bal, w_qty, discount,
               round((sum(CASE WHEN class = 2 THEN r + (ties - 1) / 2.0 END)
                      - count(*) FILTER (WHERE class = 2) * (count(*) FILTER (WHERE class = 2) + 1) / 2.0)
                     / CAST(count(*) FILTER (WHERE class = 2) * count(*) FILTER (WHERE class <> 2) AS DOUBLE), 6) AS roc_auc
        FROM rk GROUP BY w_bal, w_qty, discount),
res AS (SELECT g.config_id, g.threshold, g.w_bal, g.w_qty, g.discount,
               round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS val_accuracy,
               round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0), 6) AS val_precision,
               round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0), 6) AS val_recall,
               round(coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0), 6) AS val_f1,
               a.roc_auc AS val_roc_auc
        FROM grid g JOIN cm USING (config_id)
        JOIN auc a ON g.w_bal = a.w_bal AND g.w_qty = a.w_qty AND g.discount IS NOT DISTINCT FROM a.discount)"""

COLS = "config_id, 96 AS n_configs, threshold, w_bal, w_qty, discount, val_accuracy, val_precision, val_recall, val_f1, val_roc_auc"

ORACLE["g1_grid_results"] = with_views(RESULTS + f"\nSELECT {COLS} FROM res")
ORACLE["g4_best_config"] = with_views(RESULTS + f"\nSELECT {COLS} FROM res ORDER BY val_f1 DESC, config_id LIMIT 1")
ORACLE["g5_top10"] = with_views(RESULTS + f"\nSELECT {COLS} FROM res ORDER BY val_f1 DESC, config_id LIMIT 10")
ORACLE["g5_bottom10"] = with_views(RESULTS + f"\nSELECT {COLS} FROM res ORDER BY val_f1 ASC, config_id LIMIT 10")

_LONG = """(SELECT 'threshold' AS param, CAST(threshold AS VARCHAR) AS value, val_f1 AS m FROM res UNION ALL
   SELECT 'w_bal', CAST(w_bal AS VARCHAR), val_f1 FROM res UNION ALL
   SELECT 'w_qty', w_qty, val_f1 FROM res UNION ALL SELECT 'discount', discount, val_f1 FROM res)"""
_IMPACT = """SELECT param, value, count(*) AS n, round(avg(m), 6) AS mean, round(stddev_samp(m), 6) AS std,
       round(max(m), 6) AS max, round(min(m), 6) AS min FROM {src} l {where} GROUP BY param, value"""
ORACLE["g6_param_impact"] = with_views(RESULTS + "\n" + _IMPACT.format(src=_LONG, where=""))
ORACLE["g6_param_impact_drop_null"] = with_views(RESULTS + "\n" + _IMPACT.format(src=_LONG, where="WHERE value IS NOT NULL"))

ORACLE["g7_mean_by_key"] = with_views(RESULTS + """
SELECT discount, count(*) AS n, round(avg(val_accuracy), 6) AS mean_val_accuracy, round(avg(val_f1), 6) AS mean_val_f1,
       round(avg(val_roc_auc), 6) AS mean_val_roc_auc FROM res GROUP BY discount""")

ORACLE["g8_right_closed_bins"] = with_views(RESULTS + """
, bins AS (SELECT * FROM (VALUES (1, '(0, 50]', 0, 50), (2, '(50, 100]', 50, 100), (3, '(100, 150]', 100, 150),
                                 (4, '(150, 300]', 150, 300)) t(bin_order, bin, lo, hi)),
agg AS (SELECT b.bin, count(*) AS n, avg(val_f1) AS m FROM res r JOIN bins b ON r.w_bal * 10 > b.lo AND r.w_bal * 10 <= b.hi
        GROUP BY b.bin)
SELECT CAST(bin_order AS INTEGER) AS bin_order, b.bin, coalesce(n, 0) AS n, round(m, 6) AS mean_val_f1
FROM bins b LEFT JOIN agg USING (bin)""")

ORACLE["g9_banded_mean"] = with_views(RESULTS + """
SELECT CASE WHEN threshold <= 0.3 THEN 'strong' WHEN threshold >= 0.6 THEN 'weak' ELSE 'moderate' END AS band,
       count(*) AS n, round(avg(val_accuracy), 6) AS mean_val_accuracy, round(avg(val_f1), 6) AS mean_val_f1
FROM res GROUP BY 1""")

ORACLE["g10_tied_at_best"] = with_views(RESULTS + """
SELECT max(val_roc_auc) OVER () AS best, config_id FROM res QUALIFY val_roc_auc = max(val_roc_auc) OVER ()""".replace(
    "SELECT max(val_roc_auc) OVER () AS best, config_id FROM res QUALIFY val_roc_auc = max(val_roc_auc) OVER ()",
    "SELECT best, list_sort(list(config_id)) AS tied_values, count(*) AS n_tied FROM res, "
    "(SELECT max(val_roc_auc) AS best FROM res) b WHERE val_roc_auc = best GROUP BY best"))

# ---------------------------------------------------------------- cross-validation
CV = split_cte() + f"""
, pool AS (SELECT * FROM sp WHERE split IN ('train', 'val')),
folds AS (SELECT *, (row_number() OVER (PARTITION BY class ORDER BY {_hash('app_id', 'fold42')}, app_id) - 1) % 5 AS fold
          FROM pool),
models AS (SELECT * FROM (VALUES ('base', 10, '0.02', 0.5), ('low_threshold', 10, '0.02', 0.4),
                                 ('no_balance', 0, '0.02', 0.5)) t(model, w_bal, w_qty, t)),
pred AS (SELECT model, fold, app_id, class, p, CASE WHEN p > t THEN 2 ELSE 1 END AS yhat
         FROM (SELECT m.model, m.t, f.fold, f.app_id, f.class, {_P} AS p
               FROM (SELECT m.*, f.*, {_zd('m.w_bal', 'm.w_qty', 'TRUE')} AS zd FROM models m, folds f) x,
                    LATERAL (SELECT x.model, x.t) m, LATERAL (SELECT x.fold, x.app_id, x.class) f) y),
cnt AS (SELECT model, fold, count(*) AS n, count(*) FILTER (WHERE class = yhat) AS ok,
               count(*) FILTER (WHERE class = 2 AND yhat = 2) AS tp, count(*) FILTER (WHERE class <> 2 AND yhat = 2) AS fp,
               count(*) FILTER (WHERE class = 2 AND yhat <> 2) AS fn FROM pred GROUP BY model, fold),
rk AS (SELECT model, fold, class, rank() OVER (PARTITION BY model, fold ORDER BY p) AS r,
              count(*) OVER (PARTITION BY model, fold, p) AS ties FROM pred),
auc AS (SELECT model, fold,
               round((sum(CASE WHEN class = 2 THEN r + (ties - 1) / 2.0 END)
                      - count(*) FILTER (WHERE class = 2) * (count(*) FILTER (WHERE class = 2) + 1) / 2.0)
                     / CAST(count(*) FILTER (WHERE class = 2) * count(*) FILTER (WHERE class <> 2) AS DOUBLE), 12) AS roc_auc
        FROM rk GROUP BY model, fold),
per_fold AS (SELECT model, fold, round(ok / CAST(n AS DOUBLE), 12) AS accuracy,
                    round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0), 12) AS precision,
                    round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0), 12) AS recall,
                    round(coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0), 12) AS f1, roc_auc
             FROM cnt JOIN auc USING (model, fold)),
summary AS (SELECT model, count(*) AS n_folds,
                   round(avg(accuracy), 6) AS mean_accuracy, round(stddev_pop(accuracy), 6) AS std_accuracy,
                   round(avg(precision), 6) AS mean_precision, round(stddev_pop(precision), 6) AS std_precision,
                   round(avg(recall), 6) AS mean_recall, round(stddev_pop(recall), 6) AS std_recall,
                   round(avg(f1), 6) AS mean_f1, round(stddev_pop(f1), 6) AS std_f1,
                   round(avg(roc_auc), 6) AS mean_roc_auc, round(stddev_pop(roc_auc), 6) AS std_roc_auc
            FROM per_fold GROUP BY model)"""

ORACLE["g12_cv_summary"] = with_views(CV + "\nSELECT * FROM summary")
ORACLE["g13_cv_ranking"] = with_views(CV + """
SELECT model, round(mean_accuracy, 4) AS mean_test_score, round(std_accuracy, 4) AS std_test_score,
       CAST(rank() OVER (ORDER BY round(mean_accuracy, 4) DESC) AS INTEGER) AS rank_test_score FROM summary""")
ORACLE["g14_winner_per_metric"] = with_views(CV + """
, long AS (SELECT model, 'accuracy' AS metric, mean_accuracy AS mean FROM summary UNION ALL
           SELECT model, 'precision', mean_precision FROM summary UNION ALL SELECT model, 'recall', mean_recall FROM summary
           UNION ALL SELECT model, 'f1', mean_f1 FROM summary UNION ALL SELECT model, 'roc_auc', mean_roc_auc FROM summary)
SELECT model, metric, mean FROM long QUALIFY row_number() OVER (PARTITION BY metric ORDER BY mean DESC, model) = 1""")

ORACLE["e6_round_metrics"] = with_views("""
, m AS (SELECT config_id, count(*) AS n,
       count(*) FILTER (WHERE class = 2 AND yhat = 2) AS tp, count(*) FILTER (WHERE class <> 2 AND yhat = 2) AS fp,
       count(*) FILTER (WHERE class = 2 AND yhat <> 2) AS fn, count(*) FILTER (WHERE class <> 2 AND yhat <> 2) AS tn,
       count(*) FILTER (WHERE class = yhat) AS ok FROM models GROUP BY config_id),
f AS (SELECT *, coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f2,
             coalesce(2 * tn / nullif(CAST(2 * tn + fn + fp AS DOUBLE), 0), 0.0) AS f1 FROM m)
SELECT config_id, n, tp, fp, fn, tn, round(round(ok / CAST(n AS DOUBLE), 12), 4) AS accuracy,
       round(round(coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0), 12), 4) AS precision_pos2,
       round(round(coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0), 12), 4) AS recall_pos2,
       round(round(f2, 12), 4) AS f1_pos2, round(round(f1, 12), 4) AS f1_pos1,
       round(round(coalesce((f2 * (tp + fn) + f1 * (tn + fp)) / nullif(CAST(n AS DOUBLE), 0), 0.0), 12), 4) AS f1_weighted
FROM f""", models=8)

ORACLE["e7_relative_improvement"] = with_views(RESULTS + """
, b AS (SELECT """ + ", ".join(
    f"max({m}) FILTER (WHERE threshold = 0.5 AND w_bal = 10 AND w_qty = '0.02' AND discount = 'on') AS base_{m}, "
    f"max({m}) AS best_{m}" for m in ("val_accuracy", "val_f1", "val_roc_auc")) + """ FROM res),
l AS (""" + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, base_{m} AS base, best_{m} AS best, "
    f"round((best_{m} - base_{m}) * 100.0 / nullif(abs(base_{m}), 0), 4) AS pct_change FROM b"
    for m in ("val_accuracy", "val_f1", "val_roc_auc")) + """)
SELECT metric, base, best, pct_change,
       CASE WHEN pct_change > 0 THEN printf('%.4f%% better', pct_change)
            WHEN pct_change < 0 THEN printf('%.4f%% worse', abs(pct_change)) ELSE 'no change' END AS verdict
FROM l""")
