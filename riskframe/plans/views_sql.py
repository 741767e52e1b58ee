"""SQL text of the derived views, for the independent DuckDB oracle.

These CTE bodies restate FIXTURES.md in plain SQL; the Spark side builds the
same tables with the DataFrame API in ``riskframe.sources.tables``.
"""

APPLICATIONS = """
WITH li AS (
  SELECT l_orderkey, count(*) AS n_lines,
         sum(CAST(l_quantity AS DECIMAL(12,2))) AS qty,
         max(l_discount) AS max_discount, max(l_tax) AS max_tax,
         max(l_returnflag) AS top_flag, min(l_returnflag) AS low_flag,
         max(l_linestatus) AS top_status, min(l_linestatus) AS low_status
  FROM lineitem GROUP BY l_orderkey),
co AS (SELECT o_custkey AS ck, count(*) AS cust_orders FROM orders GROUP BY o_custkey)
SELECT o_orderkey AS app_id, o_totalprice AS total_price, c_acctbal AS acct_balance,
       {n_lines} AS n_lines,
       CAST(coalesce(qty, 0) AS DOUBLE) AS qty,
       coalesce(max_discount, 0.0) AS max_discount, coalesce(max_tax, 0.0) AS max_tax,
       cust_orders, o_orderpriority AS priority, c_mktsegment AS segment,
       n_name AS nation, r_name AS region,
       concat('Y', CAST(year(o_orderdate) AS VARCHAR)) AS order_year,
       concat('Q', CAST(quarter(o_orderdate) AS VARCHAR)) AS order_quarter,
       concat('M', CAST(month(o_orderdate) AS VARCHAR)) AS order_month,
       coalesce(top_flag, 'none') AS top_flag, coalesce(low_flag, 'none') AS low_flag,
       coalesce(top_status, 'none') AS top_status, coalesce(low_status, 'none') AS low_status,
       CASE WHEN c_acctbal < 0 THEN 'B1' WHEN c_acctbal < 5000 THEN 'B2' ELSE 'B3' END AS balance_band,
       CASE WHEN n_lines IS NULL THEN 'L0' WHEN n_lines <= 3 THEN 'L1' ELSE 'L2' END AS lines_band,
       CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS class
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN co ON ck = o_custkey
LEFT JOIN li ON l_orderkey = o_orderkey
"""

APPS = APPLICATIONS.format(n_lines="CAST(coalesce(n_lines, 0) AS BIGINT)")
APPS_RAW = APPLICATIONS.format(n_lines="CAST(n_lines AS BIGINT)")

SCORED = """
SELECT app_id, class, CAST(zd AS DOUBLE) AS z,
       round(1 / (1 + exp(-CAST(zd AS DOUBLE))), 6) AS p,
       CASE WHEN zd > 0 THEN 2 ELSE 1 END AS yhat,
       round(1 + 1 / (1 + exp(-CAST(zd AS DOUBLE))), 6) AS reg_pred
FROM (SELECT app_id, class,
             round(CAST('0.00001' AS DECIMAL(6,5)) * (CAST(total_price AS DECIMAL(12,2)) - 250000)
                 + CAST('0.0001' AS DECIMAL(5,4)) * (CAST(acct_balance AS DECIMAL(12,2)) - 4500)
                 + CAST('0.02' AS DECIMAL(3,2)) * (CAST(qty AS DECIMAL(12,2)) - 100)
                 - 3 * CAST(max_discount AS DECIMAL(6,2)), 4) AS zd
      FROM apps) q
"""

SCORED_MODELS = """
SELECT config_id, app_id, class, CAST(zd AS DOUBLE) AS z,
       round(1 / (1 + exp(-CAST(zd AS DOUBLE))), 6) AS p,
       CASE WHEN round(1 / (1 + exp(-CAST(zd AS DOUBLE))), 6) > CAST(threshold AS DOUBLE) THEN 2 ELSE 1 END AS yhat
FROM (SELECT config_id, threshold, app_id, class,
             round(CAST('0.00001' AS DECIMAL(6,5)) * (CAST(total_price AS DECIMAL(12,2)) - 250000)
                 + w_bal * CAST('0.00001' AS DECIMAL(6,5)) * (CAST(acct_balance AS DECIMAL(12,2)) - 4500)
                 + CAST('0.02' AS DECIMAL(3,2)) * (CAST(qty AS DECIMAL(12,2)) - 100)
                 - 3 * CAST(max_discount AS DECIMAL(6,2)), 4) AS zd
      FROM (SELECT a.*, CAST(g AS INTEGER) AS config_id,
                   CAST(0.25 + g * 0.05 AS DECIMAL(4,2)) AS threshold,
                   CAST(g * 5 AS DECIMAL(6,0)) AS w_bal
            FROM apps a, range(1, {n_models} + 1) t(g)) f) q
"""


def with_views(body: str, *, raw: bool = False, scored: bool = False, models: int | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (apps, optionally scored/models)."""
    ctes = [f"apps AS ({APPS_RAW if raw else APPS})"]
    if scored:
        ctes.append(f"scored AS ({SCORED})")
    if models:
        ctes.append(f"models AS ({SCORED_MODELS.format(n_models=models)})")
    return "WITH " + ",\n".join(ctes) + "\n" + body
