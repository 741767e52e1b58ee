"""DuckDB twins of the source / sink queries."""

from __future__ import annotations

from riskframe.plans.oracle import ORACLE, RUNS_SQL
from riskframe.plans.views_sql import with_views

ORACLE["s1_csv_scan"] = with_views("SELECT * FROM apps")
ORACLE["s2_csv_sink"] = with_views("""
SELECT class, CASE WHEN class = 1 THEN 'Good Credit' ELSE 'Bad Credit' END AS label_text, count(*) AS n,
       round(100.0 * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS pct
FROM apps GROUP BY class""")
ORACLE["s3_concat_by_key"] = with_views("SELECT * FROM apps")
ORACLE["s5_append_runs"] = f"""WITH {RUNS_SQL}
SELECT run_name, 'value' AS metric, count(*) AS n_runs, round(sum(metric), 4) AS total
FROM runs WHERE experiment = 'base' GROUP BY run_name"""

_LD = "ld AS (SELECT l.* FROM labels l JOIN documents d USING (doc_id))"
ORACLE["p7_imbalance_ratio_labels"] = f"""WITH {_LD}
SELECT count(*) FILTER (WHERE quality = 1) AS n_majority, count(*) FILTER (WHERE quality = 0) AS n_minority,
       round(CAST(count(*) FILTER (WHERE quality = 1) AS DOUBLE) / nullif(count(*) FILTER (WHERE quality = 0), 0), 6)
         AS imbalance_ratio
FROM ld"""
ORACLE["f8_class_weights_labels"] = f"""WITH {_LD}
SELECT quality, count(*) AS n_c, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM ld GROUP BY quality"""
