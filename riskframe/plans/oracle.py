"""Independent SQL (DuckDB dialect) for every SQL-checkable query.

Written directly from the operator definitions, with window functions and
plain aggregates - deliberately not derived from the Spark plans.
"""

from __future__ import annotations

from riskframe.plans.views_sql import with_views
from riskframe.roles import APPLICATION_ROLES as ROLES

NUM = list(ROLES.numeric)
CAT = list(ROLES.categorical)
ORACLE: dict[str, str] = {}


def _unpivot_num(src: str = "apps", ids: str = "") -> str:
    parts = [f"SELECT {ids}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}" for c in NUM]
    return "\nUNION ALL ".join(parts)


def _unpivot_cat(src: str = "apps", ids: str = "") -> str:
    parts = [f"SELECT {ids}'{c}' AS column_name, CAST({c} AS VARCHAR) AS level FROM {src}" for c in CAT]
    return "\nUNION ALL ".join(parts)


ALL_COLS = ["app_id", *NUM, *CAT, "class"]
DTYPES = {"app_id": "bigint", "total_price": "double", "acct_balance": "double", "n_lines": "bigint",
          "qty": "double", "max_discount": "double", "max_tax": "double", "cust_orders": "bigint",
          **{c: "string" for c in CAT}, "class": "int"}

# ---------------------------------------------------------------- profiling
ORACLE["p1_shape"] = with_views(f"SELECT count(*) AS n_rows, {len(ALL_COLS)} AS n_columns FROM apps")

ORACLE["p2_column_info"] = with_views("\nUNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{DTYPES[c]}' AS dtype, count({c}) AS non_null FROM apps"
    for i, c in enumerate(ALL_COLS)), raw=True)

ORACLE["p2_dtype_counts"] = with_views(
    "SELECT dtype, count(*) AS n_columns FROM (VALUES " +
    ", ".join(f"('{c}', '{DTYPES[c]}')" for c in ALL_COLS) + ") t(c, dtype) GROUP BY dtype")

ORACLE["p3_missing_report"] = with_views("""
, m AS (""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, count(*) AS n FROM apps"
    for c in ALL_COLS) + """)
SELECT column_name, n_missing, round(100.0 * n_missing / n, 4)::DOUBLE AS pct_missing,
       CAST(sum(n_missing) OVER () AS BIGINT) AS total_missing
FROM m WHERE n_missing > 0 ORDER BY n_missing DESC, column_name""", raw=True).replace("\n\n, m AS", ", m AS")

ORACLE["p4_describe"] = with_views(f"""
, long AS ({_unpivot_num()})
SELECT feature, count(value) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
       round(min(value), 4) AS min, round(quantile_cont(value, 0.25), 4) AS q25,
       round(quantile_cont(value, 0.5), 4) AS q50, round(quantile_cont(value, 0.75), 4) AS q75,
       round(max(value), 4) AS max
FROM long GROUP BY feature""")

ORACLE["p5_select_numeric"] = with_views(
    "SELECT app_id, " + ", ".join(NUM) + ", class FROM apps")

ORACLE["p6_class_distribution"] = with_views("""
SELECT class, CASE WHEN class = 1 THEN 'Good Credit' ELSE 'Bad Credit' END AS label_text, count(*) AS n,
       round(100.0 * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS pct
FROM apps GROUP BY class""")

ORACLE["p7_imbalance_ratio"] = with_views("""
SELECT count(*) FILTER (WHERE class = 1) AS n_majority, count(*) FILTER (WHERE class = 2) AS n_minority,
       round(CAST(count(*) FILTER (WHERE class = 1) AS DOUBLE)
             / nullif(count(*) FILTER (WHERE class = 2), 0), 6) AS imbalance_ratio
FROM apps""")

ORACLE["p8_duplicate_rows"] = with_views("""
SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(c - 1) AS BIGINT) AS n_duplicates
FROM (SELECT * EXCLUDE (app_id), count(*) AS c FROM apps GROUP BY ALL) g""")

ORACLE["p8_duplicate_rows_few_columns"] = with_views("""
SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(c - 1) AS BIGINT) AS n_duplicates
FROM (SELECT priority, segment, region, class, count(*) AS c FROM apps GROUP BY ALL) g""")

ORACLE["p9_histogram"] = with_views(f"""
, long AS ({_unpivot_num()}),
rng AS (SELECT feature, min(value) AS mn, max(value) AS mx FROM long WHERE value IS NOT NULL GROUP BY feature),
binned AS (
  SELECT l.feature, CASE WHEN mx = mn THEN 1
                         ELSE least(CAST(floor((value - mn) * 20 / (mx - mn)) AS INTEGER) + 1, 20) END AS bin
  FROM long l JOIN rng r USING (feature) WHERE value IS NOT NULL),
cnt AS (SELECT feature, bin, count(*) AS n FROM binned GROUP BY ALL),
grid AS (SELECT feature, mn, mx, CAST(b AS INTEGER) AS bin
         FROM rng, range(1, 21) t(b) WHERE b = 1 OR mx > mn)
SELECT g.feature, g.bin,
       round(mn + (g.bin - 1) * CASE WHEN mx = mn THEN 0.0 ELSE (mx - mn) / 20 END, 4) AS lo,
       round(CASE WHEN mx = mn THEN mx ELSE mn + g.bin * ((mx - mn) / 20) END, 4) AS hi,
       coalesce(n, 0) AS n
FROM grid g LEFT JOIN cnt c ON g.feature = c.feature AND g.bin = c.bin""")

ORACLE["p10_boxplot_by_class"] = with_views(f"""
, long AS ({_unpivot_num(ids="class, ")}),
st AS (SELECT feature, class, count(value) AS n, avg(value) AS mean,
              quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
              quantile_cont(value, 0.75) AS q3
       FROM long WHERE value IS NOT NULL GROUP BY feature, class),
fe AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM st),
tl AS (SELECT l.feature, l.class, min(value) FILTER (WHERE value >= lo_f) AS whisker_lo,
              max(value) FILTER (WHERE value <= hi_f) AS whisker_hi,
              count(*) FILTER (WHERE value < lo_f OR value > hi_f) AS n_outliers
       FROM long l JOIN fe USING (feature, class) WHERE value IS NOT NULL GROUP BY l.feature, l.class)
SELECT feature, class, n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       round(mean, 4) AS mean, round(whisker_lo, 4) AS whisker_lo, round(whisker_hi, 4) AS whisker_hi,
       n_outliers, round(median - 1.57 * (q3 - q1) / sqrt(n), 4) AS notch_lo,
       round(median + 1.57 * (q3 - q1) / sqrt(n), 4) AS notch_hi
FROM fe JOIN tl USING (feature, class)""")

_CORR_COLS = NUM + ["class"]
ORACLE["p11_correlation_matrix"] = with_views("\nUNION ALL ".join(
    [f"SELECT '{a}' AS x, '{b}' AS y, round(CASE WHEN isnan(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))) THEN NULL "
     f"ELSE corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) END, 6) AS r FROM apps"
     for a in _CORR_COLS for b in _CORR_COLS if a != b] +
    [f"SELECT '{a}' AS x, '{a}' AS y, CASE WHEN stddev_pop(CAST({a} AS DOUBLE)) > 0 THEN 1.0 END::DOUBLE AS r FROM apps"
     for a in _CORR_COLS]))

ORACLE["p12_distinct_levels"] = with_views(f"""
, long AS ({_unpivot_cat()})
SELECT column_name, count(DISTINCT level) AS n_levels FROM long GROUP BY column_name""")

ORACLE["p12_distinct_sketch_checked"] = with_views(f"""
, long AS ({_unpivot_cat()} UNION ALL SELECT 'app_id', CAST(app_id AS VARCHAR) FROM apps
           UNION ALL SELECT 'total_price', CAST(total_price AS VARCHAR) FROM apps UNION ALL SELECT 'acct_balance', CAST(acct_balance AS VARCHAR) FROM apps)
SELECT column_name, count(DISTINCT level) AS n_levels, TRUE AS estimate_ok FROM long WHERE column_name <> 'order_year' GROUP BY column_name""")

ORACLE["p13_target_correlation"] = with_views(f"""
, c AS ({' UNION ALL '.join(f"SELECT '{a}' AS feature, round(corr(CAST({a} AS DOUBLE), CAST(class AS DOUBLE)), 6) AS r FROM apps" for a in NUM)})
SELECT feature, r, abs(r) AS abs_r,
       CAST(row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, feature) AS INTEGER) AS rank
FROM c ORDER BY rank""")

ORACLE["p14_bad_rate_by_level"] = with_views(f"""
, long AS ({_unpivot_cat(ids="class, ").replace("column_name", "dimension")}
   UNION ALL SELECT class, 'total_price>250000', CASE WHEN total_price > 250000 THEN 'true' ELSE 'false' END FROM apps
   UNION ALL SELECT class, 'qty>100', CASE WHEN qty > 100 THEN 'true' ELSE 'false' END FROM apps)
SELECT dimension, level, count(*) AS n, CAST(sum(CASE WHEN class = 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_bad,
       round(sum(CASE WHEN class = 2 THEN 1 ELSE 0 END) / count(*), 6) AS bad_rate
FROM long GROUP BY dimension, level HAVING count(*) >= 30""")


# ---------------------------------------------------------------- helpers for splits / encoders
def _hash(key: str, seed) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8)) AS BIGINT)"


VAL_ADJ = 0.15 / (1 - 0.15)


def _alloc(src: str, group: str, total: str, frac: str, out: str) -> str:
    """Largest-remainder allocation of ceil(frac * N) over the rows of src."""
    return f"""(SELECT *, base_{out} + CASE WHEN row_number() OVER (ORDER BY quota_{out} - base_{out} DESC, {group})
                                  <= tgt_{out} - sum(base_{out}) OVER () THEN 1 ELSE 0 END AS {out}
   FROM (SELECT *, CAST(floor(quota_{out}) AS BIGINT) AS base_{out}
         FROM (SELECT *, tgt_{out} * {total} / n_all_{out} AS quota_{out}
               FROM (SELECT *, CAST(sum({total}) OVER () AS BIGINT) AS n_all_{out},
                            CAST(ceil(round({frac} * CAST(sum({total}) OVER () AS BIGINT), 9)) AS BIGINT) AS tgt_{out}
                     FROM {src}) a) b) c)"""


def split_cte(group: str | None = "class", seed=42, name: str = "sp", src: str = "apps") -> str:
    """CTE text producing ``{name}`` = src.* + split."""
    g = group or "grp"
    grp_expr = group or "0"
    return f"""
, {name}_cnt AS (SELECT {grp_expr} AS {g}, count(*) AS n FROM {src} GROUP BY 1),
{name}_t AS (SELECT * FROM {_alloc(f'{name}_cnt', g, 'n', 'CAST(0.15 AS DOUBLE)', 'n_test')} x),
{name}_r AS (SELECT {g}, n, n_test, n - n_test AS rest FROM {name}_t),
{name}_v AS (SELECT * FROM {_alloc(f'{name}_r', g, 'rest', f'CAST({VAL_ADJ!r} AS DOUBLE)', 'n_val')} y),
{name}_pos AS (SELECT s.*, {grp_expr} AS _g,
                 row_number() OVER (PARTITION BY {grp_expr} ORDER BY {_hash('app_id', seed)}, app_id) - 1 AS pos
               FROM {src} s),
{name} AS (SELECT p.* EXCLUDE (_g, pos),
                  CASE WHEN pos < v.n_test THEN 'test' WHEN pos < v.n_test + v.n_val THEN 'val' ELSE 'train' END AS split
           FROM {name}_pos p JOIN {name}_v v ON p._g = v.{g})"""


def vocab_cte(fit_where: str, name: str = "vocab", src: str = "apps") -> str:
    parts = "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS level FROM {src} WHERE {fit_where}" for c in CAT)
    return f"""
, {name} AS (SELECT column_name, level,
                    CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY level) - 1 AS INTEGER) AS ordinal
             FROM (SELECT DISTINCT * FROM ({parts}) u WHERE level IS NOT NULL) d)"""


CAT_POS = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CAT))

# ---------------------------------------------------------------- expressions
ORACLE["e1_drop_label"] = with_views("SELECT * EXCLUDE (class) FROM apps")

ORACLE["e2_cast_report"] = with_views("""
, src AS (SELECT priority, top_flag, CAST(n_lines AS VARCHAR) AS n_lines, substr(order_year, 2, 4) AS year_digits FROM apps),
long AS (SELECT 'priority' AS column_name, priority AS raw FROM src UNION ALL
         SELECT 'top_flag', top_flag FROM src UNION ALL SELECT 'n_lines', n_lines FROM src UNION ALL
         SELECT 'year_digits', year_digits FROM src)
SELECT column_name, count(TRY_CAST(raw AS INTEGER)) AS n_ok,
       count(*) FILTER (WHERE TRY_CAST(raw AS INTEGER) IS NULL) AS n_rejected,
       CAST(sum(TRY_CAST(raw AS INTEGER)) AS BIGINT) AS sum_ok
FROM long WHERE raw IS NOT NULL GROUP BY column_name""")

ORACLE["e3_conjunctive_filter"] = with_views("""
SELECT app_id, total_price, segment, class FROM apps
WHERE class = 2 AND total_price BETWEEN 100000 AND 300000 AND segment = 'BUILDING'""")

ORACLE["e4_membership"] = with_views("""
SELECT app_id, priority, order_year, n_lines FROM apps
WHERE priority IN ('1-URGENT', '2-HIGH') AND n_lines IS NOT NULL
  AND order_year IN (SELECT order_year FROM apps WHERE order_year < 'Y2000')""", raw=True)

ORACLE["e4_unseen_levels"] = with_views(vocab_cte("order_year < 'Y2000'") + """
, long AS (""" + "\nUNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS level FROM apps" for c in CAT) + """)
SELECT column_name, level, count(*) AS n_rows FROM long l
WHERE NOT EXISTS (SELECT 1 FROM vocab v WHERE v.column_name = l.column_name AND v.level = l.level)
GROUP BY column_name, level""")

ORACLE["e5_threshold_label"] = with_views("""
SELECT app_id, p, CASE WHEN p > 0.5 THEN 2 ELSE 1 END AS label_05, CASE WHEN p > 0.4 THEN 2 ELSE 1 END AS label_04
FROM scored""", scored=True)

ORACLE["e8_feature_names"] = with_views(split_cte() + vocab_cte("split = 'train'", src="sp") + """
SELECT column_name, level, ordinal, column_name || '_' || CAST(ordinal AS VARCHAR) AS feature_name
FROM vocab WHERE ordinal > 0""")

ORACLE["e9_array_functions"] = with_views("""
, a AS (SELECT app_id, list_filter([CAST(n_lines * 16 AS INTEGER), CAST(cust_orders AS INTEGER), 8], lambda v: v > 0) AS layers
        FROM apps)
SELECT app_id, CAST(len(layers) AS INTEGER) AS n_layers, CAST(list_sum(layers) AS BIGINT) AS total_units,
       '(' || array_to_string(layers, ', ') || ')' AS layers_text,
       CAST(replace(replace('(' || array_to_string(layers, ', ') || ')', '(', '['), ')', ']') AS INTEGER[]) = layers
         AS roundtrip_ok
FROM a""")

ORACLE["e10_math_functions"] = with_views("""
SELECT app_id, abs(z) AS abs_z, round(sqrt(abs(z)), 6) AS sqrt_abs_z, round(pow(z, 2), 6) AS z_sq FROM scored""",
                                          scored=True)

RUNS_SQL = """runs AS (SELECT event_id AS run_id, CASE WHEN user_id % 2 = 0 THEN 'base' ELSE 'tuned' END AS experiment,
                      event_type AS run_name, ts AS start_time, value AS metric, props FROM events)"""

ORACLE["e11_epoch_ms_duration"] = f"""
WITH {RUNS_SQL},
ms AS (SELECT experiment, run_name, CAST(floor(epoch_us(start_time) / 1000) AS BIGINT) AS ms FROM runs)
SELECT experiment, run_name, min(ms) AS start_ms, max(ms) AS end_ms,
       round((max(ms) - min(ms)) / 1000.0, 3)::DOUBLE AS duration_s
FROM ms GROUP BY experiment, run_name"""

# ---------------------------------------------------------------- splits
ORACLE["t1_stratified_split"] = with_views(split_cte() + "\nSELECT app_id, class, split FROM sp")
ORACLE["t2_random_split"] = with_views(split_cte(group=None) + "\nSELECT app_id, class, split FROM sp")
ORACLE["t3_stratified_folds"] = with_views(f"""
SELECT app_id, class,
       CAST((row_number() OVER (PARTITION BY class ORDER BY {_hash('app_id', 'fold42')}, app_id) - 1) % 5 AS INTEGER) AS fold
FROM apps""")
ORACLE["t4_pool_train_val"] = with_views(split_cte() + "\nSELECT app_id, class, split FROM sp WHERE split IN ('train', 'val')")
ORACLE["t5_split_audit"] = with_views(split_cte() + """
SELECT split, class, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS class_share
FROM sp GROUP BY split, class""")
ORACLE["t5_split_overlap"] = with_views(split_cte() + """
SELECT app_id, count(DISTINCT split) AS n_splits FROM sp GROUP BY app_id HAVING count(DISTINCT split) > 1""")

# ---------------------------------------------------------------- encoders
_ENC_COLS = ",\n       ".join(
    f"coalesce((SELECT ordinal FROM vocab v WHERE v.column_name = '{c}' AND v.level = a.{c}), 0) AS {c}" for c in CAT)

ORACLE["f1_label_encode"] = with_views(vocab_cte("order_year < 'Y2000'") + f"""
SELECT app_id, {_ENC_COLS} FROM apps a""")

_MANY = """WITH o AS (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day, CAST(o_custkey AS VARCHAR) AS customer FROM orders),
d AS (SELECT order_day AS level, CAST(dense_rank() OVER (ORDER BY order_day) - 1 AS INTEGER) AS ordinal
      FROM (SELECT DISTINCT order_day FROM o WHERE order_day < '1998-01-01') x),
c AS (SELECT customer AS level, CAST(dense_rank() OVER (ORDER BY customer) - 1 AS INTEGER) AS ordinal
      FROM (SELECT DISTINCT customer FROM o WHERE order_day < '1998-01-01') x)
"""

ORACLE["f1_label_encode_many_levels"] = _MANY + """
SELECT o_orderkey, coalesce(d.ordinal, 0) AS order_day, coalesce(c.ordinal, 0) AS customer
FROM o LEFT JOIN d ON d.level = order_day LEFT JOIN c ON c.level = customer"""

ORACLE["f2_one_hot_many_levels"] = _MANY + """
SELECT o_orderkey, 'order_day_' || CAST(ordinal AS VARCHAR) AS feature, 1 AS value FROM o JOIN d ON level = order_day WHERE ordinal > 0
UNION ALL
SELECT o_orderkey, 'customer_' || CAST(ordinal AS VARCHAR), 1 FROM o JOIN c ON level = customer WHERE ordinal > 0"""

ORACLE["f2_one_hot_drop_first"] = with_views(vocab_cte("order_year < 'Y2000'") + """
, long AS (""" + "\nUNION ALL ".join(f"SELECT app_id, '{c}' AS column_name, CAST({c} AS VARCHAR) AS level FROM apps" for c in CAT) + """)
SELECT l.app_id, v.column_name || '_' || CAST(v.ordinal AS VARCHAR) AS feature, 1 AS value
FROM long l JOIN vocab v ON v.column_name = l.column_name AND v.level = l.level WHERE v.ordinal > 0""")


def _scale_cte(src: str = "sp") -> str:
    return ", st AS (SELECT " + ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS m_{c}, CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1.0 "
        f"ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS s_{c}" for c in NUM) + f" FROM {src} WHERE split = 'train')"


ORACLE["f3_standard_scale"] = with_views(split_cte() + "\n" + _scale_cte() + "\nSELECT app_id, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - m_{c}) / s_{c}, 6) AS {c}" for c in NUM) + " FROM sp, st")

ORACLE["f4_interaction"] = with_views(
    "SELECT app_id, round(CAST(n_lines AS DOUBLE) * max_discount, 6) AS n_lines_x_max_discount FROM apps")

_DESIGN = (split_cte() + "\n" + _scale_cte() + vocab_cte("split = 'train'", src="sp") + f"""
, widths AS (SELECT column_name, count(*) - 1 AS w, CASE column_name {CAT_POS} END AS cpos FROM vocab GROUP BY column_name),
offs AS (SELECT column_name, {len(NUM)} + coalesce(sum(w) OVER (ORDER BY cpos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base
         FROM widths),
num AS (""" + "\nUNION ALL ".join(
    f"SELECT app_id, {i} AS feature_index, '{c}' AS feature, (CAST({c} AS DOUBLE) - m_{c}) / s_{c} AS value FROM sp, st"
    for i, c in enumerate(NUM)) + """),
cat_long AS (""" + "\nUNION ALL ".join(
    f"SELECT app_id, '{c}' AS column_name, CAST({c} AS VARCHAR) AS level FROM sp" for c in CAT) + """),
cat AS (SELECT l.app_id, CAST(o.base + v.ordinal - 1 AS INTEGER) AS feature_index,
               v.column_name || '_' || CAST(v.ordinal AS VARCHAR) AS feature, 1.0 AS value
        FROM cat_long l JOIN vocab v ON v.column_name = l.column_name AND v.level = l.level
        JOIN offs o ON o.column_name = v.column_name WHERE v.ordinal > 0),
design AS (SELECT * FROM num UNION ALL SELECT * FROM cat)""")

ORACLE["f5_assemble"] = with_views(_DESIGN + """
, dims AS (SELECT CAST(max(base) + 0 AS INTEGER) AS d FROM (SELECT base + w AS base FROM offs JOIN widths USING (column_name)))
SELECT sp.app_id, (SELECT d FROM dims) AS n_features,
       CAST(count(*) FILTER (WHERE value <> 0) AS INTEGER) AS n_nonzero,
       round(sum(abs(value)), 4) AS l1_norm
FROM sp JOIN design d ON d.app_id = sp.app_id GROUP BY sp.app_id""")

ORACLE["f6_tree_prep"] = with_views(split_cte() + vocab_cte("split = 'train'", src="sp") + "\nSELECT app_id, " +
                                    ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUM) + ",\n       " +
                                    _ENC_COLS + " FROM sp a")

ORACLE["f7_linear_prep"] = with_views(_DESIGN + """
SELECT app_id, CAST(feature_index AS INTEGER) AS feature_index, feature, round(value, 6) AS value
FROM design WHERE value <> 0""")

ORACLE["f8_class_weights"] = with_views(split_cte() + """
, tr AS (SELECT app_id, class FROM sp WHERE split = 'train'),
cw AS (SELECT class, (SELECT count(*) FROM tr) / ((SELECT count(DISTINCT class) FROM tr) * count(*)) AS w FROM tr GROUP BY class)
SELECT app_id, tr.class, round(w, 6) AS weight FROM tr JOIN cw USING (class)""")

import riskframe.plans.o_metrics  # noqa: E402,F401  (registers M12/M13/V* twins)

import riskframe.plans.o_tune  # noqa: E402,F401  (registers G* twins)

import riskframe.plans.o_runs  # noqa: E402,F401  (registers L* twins)

import riskframe.plans.o_sources  # noqa: E402,F401  (registers S* twins)

import riskframe.plans.o_neighbors  # noqa: E402,F401  (registers R*, L9 twins)

import riskframe.plans.o_checks  # noqa: E402,F401  (registers the twins of the model facts)
