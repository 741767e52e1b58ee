"""DuckDB twins of the model facts: counts from the split, facts that must hold."""

from __future__ import annotations

from riskframe.plans.oracle import _DESIGN, ORACLE, split_cte
from riskframe.plans.q_models import C_GRID, ELASTIC_ALPHAS, ELASTIC_RATIOS, RIDGE_LASSO_ALPHAS
from riskframe.plans.views_sql import with_views


def _counts(*facts: str, where: str = "split IN ('val', 'test')", extra: str = "count(*) FILTER (WHERE class = 2) AS n_pos") -> str:
    return with_views(split_cte() + "\nSELECT split, count(*) AS n, " + extra + "".join(f", TRUE AS {f}" for f in facts)
                      + f" FROM sp WHERE {where} GROUP BY split")


for _key, _facts in {
    "m1_logistic_l1_checked": ("optimal",), "m2_logistic_l2_checked": ("optimal",),
    "m6_ols_checked": ("optimal", "intercept_ok"), "m6_ols_no_intercept_checked": ("optimal", "intercept_ok"),
    "m7_ridge_checked": ("optimal", "intercept_ok"), "m8_lasso_checked": ("optimal", "intercept_ok"),
    "m9_elasticnet_checked": ("optimal", "intercept_ok"),
    "m10_mlp_checked": ("probabilities_ok", "loss_ok", "auc_ok"), "m11_predict_proba_checked": ("probabilities_ok", "recomputed_ok"),
    **{k: ("depth_ok", "leaf_size_ok", "leaf_value_ok") for k in
       ("m3_decision_tree_checked", "m4_tree_subset_sqrt_checked", "m4_tree_subset_log2_checked", "m4_tree_subset_half_checked", "m5_tree_regressor_checked")},
}.items():
    ORACLE[_key] = _counts(*_facts)

ORACLE["s6_model_roundtrip_checked"] = _counts(extra="count(*) AS n_equal")
ORACLE["g11_refit_best_checked"] = _counts("first_best", "same_score", where="split = 'test'")
ORACLE["s7_loss_curve_checked"] = "SELECT 'logistic_l1' AS run_id, TRUE AS starts_at_zero, TRUE AS never_rises"
ORACLE["l8_learning_curves_checked"] = """SELECT unnest(['classification:mlp', 'regression:ridge']) AS run_id,
       TRUE AS starts_at_zero, TRUE AS never_rises"""
ORACLE["g2_grid_checked"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({i + 1}, {float(c)!r}::DOUBLE, {str(c < 0).upper()}, {str(c > 0).upper()})" for i, c in enumerate([*C_GRID, -1.0])) + ") t(config_id, \"C\", failed, metrics_ok)"


def _doubles(values) -> str:
    return "[" + ", ".join(f"{float(v)!r}::DOUBLE" for v in values) + "]"


# the grid is made anew here: families in order, strengths, mixings, intercepts
ORACLE["g2_linear_grid_checked"] = f"""
WITH g AS (
  SELECT 1 AS f, 'LinearRegression' AS model_type, NULL::DOUBLE AS alpha, NULL::DOUBLE AS l1_ratio
  UNION ALL SELECT 2, 'Ridge', unnest({_doubles(RIDGE_LASSO_ALPHAS)}), NULL
  UNION ALL SELECT 3, 'Lasso', unnest({_doubles(RIDGE_LASSO_ALPHAS)}), NULL
  UNION ALL SELECT 4, 'ElasticNet', a, r FROM (SELECT unnest({_doubles(ELASTIC_ALPHAS)}) AS a) x, (SELECT unnest({_doubles(ELASTIC_RATIOS)}) AS r) y),
i AS (SELECT unnest([true, false]) AS fit_intercept)
SELECT CAST(row_number() OVER (ORDER BY f, alpha, l1_ratio, fit_intercept DESC) AS INTEGER) AS config_id, model_type, alpha, l1_ratio, fit_intercept,
       FALSE AS failed, TRUE AS optimal, TRUE AS moments_equal_rows FROM g, i"""

ORACLE["g2_moments"] = with_views(_DESIGN + """
, z AS (SELECT app_id, split, -1 AS i, CAST(class AS DOUBLE) AS v FROM sp
        UNION ALL SELECT app_id, split, 0, 1.0::DOUBLE FROM sp
        UNION ALL SELECT d.app_id, sp.split, CAST(d.feature_index + 1 AS INTEGER), d.value FROM design d JOIN sp ON sp.app_id = d.app_id WHERE d.value <> 0)
SELECT split, i, j, value FROM (SELECT a.split, a.i, b.i AS j, round(sum(a.v * b.v), 4) + 0.0 AS value
                                FROM z a JOIN z b ON a.app_id = b.app_id AND a.i <= b.i GROUP BY a.split, a.i, b.i) q WHERE value <> 0""")
