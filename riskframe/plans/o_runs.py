"""DuckDB twins of the leaderboard queries."""

from __future__ import annotations

from riskframe.plans.o_tune import _zd
from riskframe.plans.oracle import ORACLE, RUNS_SQL, split_cte
from riskframe.plans.views_sql import with_views

R = f"WITH {RUNS_SQL}\n"

ORACLE["l1_latest_run_per_name"] = R + """
SELECT run_name, run_id, start_time, metric FROM runs WHERE experiment = 'base'
QUALIFY row_number() OVER (PARTITION BY run_name ORDER BY start_time DESC, run_id DESC) = 1"""

ORACLE["l2_search_runs"] = R + """
SELECT run_id, run_name, start_time, metric, json_extract_string(props, '$.k') AS k FROM runs
WHERE run_name = 'purchase' AND json_extract_string(props, '$.k') = '42'
ORDER BY start_time DESC, run_id DESC LIMIT 1"""

ORACLE["l3_preferred_or_fallback"] = R + """
, f AS (SELECT *, date_trunc('hour', start_time) AS hour, CASE run_name WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 END AS prio FROM runs
      WHERE run_name IN ('purchase', 'signup'))
SELECT experiment, hour, run_id, run_name, start_time, metric FROM f
QUALIFY row_number() OVER (PARTITION BY experiment, hour ORDER BY prio, start_time DESC, run_id DESC) = 1"""

ORACLE["s4_tracking_scan"] = R + """
, d AS (SELECT *, CAST(start_time AS DATE) AS day, CAST(floor(epoch_us(start_time) / 1000) AS BIGINT) AS ms, hour(start_time) AS step FROM runs),
h AS (SELECT experiment, run_name, day, step, max(metric) AS value FROM d GROUP BY ALL)
SELECT 'run_' || d.run_name || '_' || strftime(d.day, '%Y%m%d') AS run_id, d.experiment, d.run_name, min(ms) AS start_ms, max(ms) AS end_ms,
       CAST(d.day AS VARCHAR) AS day, d.run_name AS kind, any_value(v.value) AS value
FROM d JOIN (SELECT experiment, run_name, day, arg_max(value, step) AS value FROM h GROUP BY ALL) v
  ON v.experiment = d.experiment AND v.run_name = d.run_name AND v.day = d.day
GROUP BY d.experiment, d.run_name, d.day"""

ORACLE["l4_best_run_text_ids"] = R + """
SELECT experiment, 'run-' || CAST(run_id AS VARCHAR) AS run_id, run_name, metric FROM runs WHERE metric IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY metric DESC, 'run-' || CAST(run_id AS VARCHAR)) = 1"""

ORACLE["l4_best_run"] = R + """
SELECT experiment, run_id, run_name, metric FROM runs WHERE metric IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY metric DESC, run_id) = 1"""

ORACLE["l4_best_run_asc"] = R + """
SELECT experiment, run_id, run_name, metric FROM runs WHERE metric IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY metric ASC, run_id) = 1"""

MSM = split_cte() + f"""
, models AS (SELECT * FROM (VALUES ('base', 10, '0.02', 0.5), ('low_threshold', 10, '0.02', 0.4),
                                   ('no_balance', 0, '0.02', 0.5)) t(model, w_bal, w_qty, t)),
pred AS (SELECT model, split, app_id, class, p, CASE WHEN p > t THEN 2 ELSE 1 END AS yhat
         FROM (SELECT m.model, m.t, s.split, s.app_id, s.class,
                      round(1 / (1 + exp(-CAST({_zd('m.w_bal', 'm.w_qty', 'TRUE')} AS DOUBLE))), 6) AS p
               FROM models m, (SELECT * FROM sp WHERE split IN ('val', 'test')) s) x),
cnt AS (SELECT model, split, count(*) AS n, count(*) FILTER (WHERE class = yhat) AS ok,
               count(*) FILTER (WHERE class = 2 AND yhat = 2) AS tp, count(*) FILTER (WHERE class <> 2 AND yhat = 2) AS fp,
               count(*) FILTER (WHERE class = 2 AND yhat <> 2) AS fn FROM pred GROUP BY model, split),
rk AS (SELECT model, split, class, rank() OVER (PARTITION BY model, split ORDER BY p) AS r,
              count(*) OVER (PARTITION BY model, split, p) AS ties FROM pred),
auc AS (SELECT model, split,
               round((sum(CASE WHEN class = 2 THEN r + (ties - 1) / 2.0 END)
                      - count(*) FILTER (WHERE class = 2) * (count(*) FILTER (WHERE class = 2) + 1) / 2.0)
                     / CAST(count(*) FILTER (WHERE class = 2) * count(*) FILTER (WHERE class <> 2) AS DOUBLE), 12) AS roc_auc
        FROM rk GROUP BY model, split),
msm AS (SELECT model, split, round(ok / CAST(n AS DOUBLE), 12) AS accuracy,
               round(coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0), 12) AS f1, roc_auc
        FROM cnt JOIN auc USING (model, split)),
tbl AS (SELECT model AS "Model",
               round(max(accuracy) FILTER (WHERE split = 'val'), 4) AS "Val_accuracy",
               round(max(f1) FILTER (WHERE split = 'val'), 4) AS "Val_f1",
               round(max(roc_auc) FILTER (WHERE split = 'val'), 4) AS "Val_roc_auc",
               round(max(accuracy) FILTER (WHERE split = 'test'), 4) AS "Test_accuracy",
               round(max(f1) FILTER (WHERE split = 'test'), 4) AS "Test_f1",
               round(max(roc_auc) FILTER (WHERE split = 'test'), 4) AS "Test_roc_auc"
        FROM msm GROUP BY model)"""

ORACLE["l5_comparison_table"] = with_views(MSM + "\nSELECT * FROM tbl")
ORACLE["l6_champion"] = with_views(MSM + """
, s AS (SELECT max("Val_f1") FILTER (WHERE "Model" = 'base') AS champion_score,
               max("Val_f1") FILTER (WHERE "Model" = 'low_threshold') AS challenger_score FROM tbl)
SELECT champion_score, challenger_score,
       CASE WHEN challenger_score >= champion_score THEN 'low_threshold' ELSE 'base' END AS chosen FROM s""")

ORACLE["l7_wide_summary"] = R + """
SELECT run_name, round(avg(metric) FILTER (WHERE experiment = 'base'), 4) AS base,
       round(avg(metric) FILTER (WHERE experiment = 'tuned'), 4) AS tuned
FROM runs GROUP BY run_name"""
