"""Driver tables and the two derived views every operator runs on.

``applications`` is one row per order with 7 numeric and 13 categorical
features plus the ``class`` label; ``scored`` is a deterministic
predictions table (no trainer involved) that feeds the metric operators.
Both are lazy plans over the parquet tables, so their work grows with the
data and Catalyst prunes columns / pushes filters into the scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _line_summary(lineitem: DataFrame) -> DataFrame:
    # Partial (map-side) aggregation on l_orderkey before the shuffle.
    return (lineitem.groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_lines_raw"),
                 F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("qty_dec"),
                 F.max("l_discount").alias("max_discount_raw"),
                 F.max("l_tax").alias("max_tax_raw"),
                 F.max("l_returnflag").alias("top_flag_raw"),
                 F.min("l_returnflag").alias("low_flag_raw"),
                 F.max("l_linestatus").alias("top_status_raw"),
                 F.min("l_linestatus").alias("low_status_raw")))


def _orders_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    cust_orders = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("cust_orders"))
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    cust = (customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
            .join(cust_orders, "c_custkey")
            .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))
    return (orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus")
            .join(cust, F.col("o_custkey") == F.col("c_custkey")))


_CLASS = "CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END"


def application_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and class of :func:`applications`: what a split needs, without the
    lineitem summary."""
    return _orders_of_customers(spark, sf_dir).select(F.col("o_orderkey").alias("app_id"), F.expr(_CLASS).alias("class"))


def applications(spark: SparkSession, sf_dir: str, coalesce_lines: bool = True) -> DataFrame:
    """The labelled application table (FIXTURES.md §2).

    Plan shape: orders-per-customer is a partial aggregate on o_custkey that
    is joined to customer on the same key (co-partitioned), the customer side
    is then joined to orders on custkey, and the lineitem summary (partially
    aggregated on l_orderkey) is left-joined on the order key.  nation/region
    are dimension tables; Spark broadcasts them from their file statistics.
    With ``coalesce_lines=False`` orders without lines keep NULL ``n_lines``
    (the missing-value case).
    """
    li = _line_summary(read_table(spark, sf_dir, "lineitem"))
    base = _orders_of_customers(spark, sf_dir).join(li, F.col("l_orderkey") == F.col("o_orderkey"), "left")

    n_lines = F.col("n_lines_raw").cast("bigint")
    return base.select(
        F.col("o_orderkey").alias("app_id"),
        F.col("o_totalprice").alias("total_price"),
        F.col("c_acctbal").alias("acct_balance"),
        (F.coalesce(n_lines, F.lit(0).cast("bigint")) if coalesce_lines else n_lines).alias("n_lines"),
        F.coalesce(F.col("qty_dec"), F.lit(0)).cast("double").alias("qty"),
        F.coalesce(F.col("max_discount_raw"), F.lit(0.0)).alias("max_discount"),
        F.coalesce(F.col("max_tax_raw"), F.lit(0.0)).alias("max_tax"),
        F.col("cust_orders"),
        F.col("o_orderpriority").alias("priority"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
        F.concat(F.lit("Y"), F.year("o_orderdate").cast("string")).alias("order_year"),
        F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")).alias("order_quarter"),
        F.concat(F.lit("M"), F.month("o_orderdate").cast("string")).alias("order_month"),
        F.coalesce(F.col("top_flag_raw"), F.lit("none")).alias("top_flag"),
        F.coalesce(F.col("low_flag_raw"), F.lit("none")).alias("low_flag"),
        F.coalesce(F.col("top_status_raw"), F.lit("none")).alias("top_status"),
        F.coalesce(F.col("low_status_raw"), F.lit("none")).alias("low_status"),
        F.when(F.col("c_acctbal") < 0, "B1").when(F.col("c_acctbal") < 5000, "B2").otherwise("B3").alias("balance_band"),
        F.when(F.col("n_lines_raw").isNull(), "L0").when(F.col("n_lines_raw") <= 3, "L1").otherwise("L2").alias("lines_band"),
        F.expr(_CLASS).alias("class"),
    )


def _dec(value: str, precision: int, scale: int) -> Column:
    return F.lit(value).cast(f"decimal({precision},{scale})")


def linear_score(apps: DataFrame) -> Column:
    """Fixed linear score in DECIMAL arithmetic so every engine agrees."""
    return F.round(
        _dec("0.00001", 6, 5) * (F.col("total_price").cast("decimal(12,2)") - 250000)
        + _dec("0.0001", 5, 4) * (F.col("acct_balance").cast("decimal(12,2)") - 4500)
        + _dec("0.02", 3, 2) * (F.col("qty").cast("decimal(12,2)") - 100)
        - 3 * F.col("max_discount").cast("decimal(6,2)"), 4)


def scored(spark: SparkSession, sf_dir: str, apps: DataFrame | None = None, keep: tuple = ()) -> DataFrame:
    """Deterministic predictions ``(app_id, class, z, p, yhat, reg_pred)`` (FIXTURES.md §3);
    ``keep`` carries extra columns of ``apps`` (e.g. ``split``) through."""
    apps = apps if apps is not None else applications(spark, sf_dir)
    zd = linear_score(apps)
    q = apps.select("app_id", "class", *keep, zd.alias("zd"))
    zdouble = F.col("zd").cast("double")
    sig = 1 / (1 + F.exp(-zdouble))
    return q.select(
        "app_id", "class", *keep,
        zdouble.alias("z"),
        F.round(sig, 6).alias("p"),
        F.when(F.col("zd") > 0, 2).otherwise(1).alias("yhat"),
        F.round(1 + sig, 6).alias("reg_pred"),
    )


def scored_models(spark: SparkSession, sf_dir: str, n_models: int = 8) -> DataFrame:
    """Multi-model predictions in long form: one row per (config_id, app_id).

    Models differ in threshold and in the weight of the balance term; the
    config table is ``spark.range(n_models)`` so the fan-out factor is a
    parameter, not data.  Feeds V12 and the grid-analysis operators.
    """
    apps = applications(spark, sf_dir)
    base = apps.select("app_id", "class", "total_price", "acct_balance", "qty", "max_discount")
    # One row per (config, application): the config list is a parameter of
    # n_models entries generated by `sequence`, so the fan-out is by a fixed
    # factor and involves no join.
    cid = F.col("cfg")
    fanned = base.withColumn("cfg", F.explode(F.sequence(F.lit(1), F.lit(n_models))))
    fanned = fanned.select(
        "app_id", "class", "total_price", "acct_balance", "qty", "max_discount",
        cid.cast("int").alias("config_id"),
        # threshold on p in 0.30 .. 0.65, balance weight 0.00005 .. 0.00040
        (F.lit(0.25) + cid * F.lit(0.05)).cast("decimal(4,2)").alias("threshold"),
        (cid * F.lit(5)).cast("decimal(6,0)").alias("w_bal"))
    zd = F.round(
        _dec("0.00001", 6, 5) * (F.col("total_price").cast("decimal(12,2)") - 250000)
        + F.col("w_bal") * _dec("0.00001", 6, 5) * (F.col("acct_balance").cast("decimal(12,2)") - 4500)
        + _dec("0.02", 3, 2) * (F.col("qty").cast("decimal(12,2)") - 100)
        - 3 * F.col("max_discount").cast("decimal(6,2)"), 4)
    joined = fanned.select("config_id", "threshold", "app_id", "class", zd.alias("zd"))
    p = F.round(1 / (1 + F.exp(-F.col("zd").cast("double"))), 6)
    return joined.select("config_id", "app_id", "class", F.col("zd").cast("double").alias("z"), p.alias("p"),
                         F.when(p > F.col("threshold").cast("double"), 2).otherwise(1).alias("yhat"))
