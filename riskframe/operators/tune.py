"""Hyper-parameter grids and the analysis of their result tables.

A grid is parameter-sized (tens to tens of thousands of configurations), so
it is built with chained ``posexplode`` on one row and numbered in
nested-loop order arithmetically (mixed radix) - no window, no join.
Scoring many configurations over the data fans rows out only by the number
of distinct *scorers*; decision thresholds are applied as conditional
counts inside one aggregation.  Result-table analysis works on one row per
configuration, so windows over it are bounded by the grid size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def param_grid(spark: SparkSession, params: Mapping[str, Sequence], id_col: str = "config_id") -> DataFrame:
    """G1: Cartesian product of value lists, ``config_id`` = 1-based position
    in nested-loop order (last parameter fastest), plus ``n_configs``."""
    names = list(params)
    df = spark.range(1).select()
    sizes = [len(params[n]) for n in names]
    for n in names:
        vals = list(params[n])
        lit_arr = F.array(*[F.lit(v) for v in vals])
        df = df.select("*", F.posexplode(lit_arr).alias(f"_i_{n}", n))
    cid = F.lit(0)
    for n, size in zip(names, sizes):
        cid = cid * size + F.col(f"_i_{n}")
    total = 1
    for s in sizes:
        total *= s
    return df.select((cid + 1).cast("int").alias(id_col), *names, F.lit(total).alias("n_configs"))


def best_config(results: DataFrame, metric: str, ascending: bool = False, key: str = "config_id") -> DataFrame:
    """The first configuration at the best metric value (ties: lowest key)."""
    order = F.asc(metric) if ascending else F.desc(metric)
    w = Window.partitionBy(F.lit(0)).orderBy(order, key)   # one row per configuration
    return results.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def top_k(results: DataFrame, metric: str, k: int = 10, ascending: bool = False, key: str = "config_id") -> DataFrame:
    """``nlargest`` / ``nsmallest`` with stable ties (TakeOrderedAndProject)."""
    order = F.asc(metric) if ascending else F.desc(metric)
    return results.orderBy(order, key).limit(k)


def param_impact(results: DataFrame, params: Sequence[str], metric: str, keep_null: bool = True,
                 digits: int = 6) -> DataFrame:
    """Per (parameter, value): mean, sample std, max, min of ``metric``.
    Values are unpivoted as strings so one aggregation serves every
    parameter; ``keep_null=False`` drops NULL values like pandas does."""
    long = (results.select(F.col(metric).cast("double").alias("_m"),
                           *[F.col(p).cast("string").alias(p) for p in params])
            .unpivot(["_m"], list(params), "param", "value"))
    if not keep_null:
        long = long.where(F.col("value").isNotNull())
    return long.groupBy("param", "value").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("_m"), digits).alias("mean"),
        F.round(F.stddev_samp("_m"), digits).alias("std"), F.round(F.max("_m"), digits).alias("max"),
        F.round(F.min("_m"), digits).alias("min"))


def mean_by(results: DataFrame, keys: Sequence[str], metrics: Sequence[str], digits: int = 6) -> DataFrame:
    """Mean of several metrics per key."""
    return results.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                      *[F.round(F.avg(m), digits).alias(f"mean_{m}") for m in metrics])


def right_closed_bin(col: str | Column, edges: Sequence[float]) -> Column:
    """Label of the right-closed bin ``(e_i, e_i+1]`` holding the value
    (NULL outside), as a CASE expression - no range join."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for lo, hi in zip(edges[:-1], edges[1:]):
        label = f"({lo:g}, {hi:g}]"
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def binned_summary(results: DataFrame, col: str, edges: Sequence[float], metric: str, digits: int = 6) -> DataFrame:
    """Mean metric per right-closed bin, empty bins kept (count 0)."""
    spark = results.sparkSession
    bins = spark.createDataFrame([(i + 1, f"({lo:g}, {hi:g}]") for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:]))],
                                 "bin_order int, bin string")
    agg = (results.withColumn("bin", right_closed_bin(col, edges)).where(F.col("bin").isNotNull())
           .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(metric).alias("_m")))
    # both sides have one row per bin
    return (bins.join(agg, "bin", "left")
            .select("bin_order", "bin", F.coalesce("n", F.lit(0)).alias("n"), F.round("_m", digits).alias(f"mean_{metric}")))


def banded_mean(results: DataFrame, band: Column, metrics: Sequence[str], digits: int = 6) -> DataFrame:
    """Averages per band of a parameter (e.g. strong / moderate / weak)."""
    return (results.withColumn("band", band).groupBy("band")
            .agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(m), digits).alias(f"mean_{m}") for m in metrics]))


def tied_at_best(results: DataFrame, metric: str, value_col: str, ascending: bool = False) -> DataFrame:
    """Best metric value and every ``value_col`` reaching it (sorted)."""
    best = F.min(metric) if ascending else F.max(metric)
    top = results.agg(best.alias("best"))
    hit = results.join(F.broadcast(top), F.col(metric) == F.col("best"))      # 1-row side
    return hit.groupBy("best").agg(F.array_sort(F.collect_list(F.col(value_col))).alias("tied_values"),
                                   F.count(F.lit(1)).alias("n_tied"))


def competition_rank(results: DataFrame, metric: str, key: str, col: str = "rank") -> DataFrame:
    """Ranks 1,1,3,3,5... by metric descending."""
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc(metric))   # one row per configuration
    return results.withColumn(col, F.rank().over(w))


def winner_per_metric(long: DataFrame, model: str = "model", metric: str = "metric", value: str = "mean") -> DataFrame:
    """Per metric, the model with the highest mean (ties: model name)."""
    w = Window.partitionBy(metric).orderBy(F.desc(value), model)     # models x metrics rows
    return long.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def fold_summary(per_fold: DataFrame, keys: Sequence[str], metrics: Sequence[str], digits: int = 6) -> DataFrame:
    """Mean and population std of each metric over folds."""
    out = []
    for m in metrics:
        out += [F.round(F.avg(m), digits).alias(f"mean_{m}"), F.round(F.stddev_pop(m), digits).alias(f"std_{m}")]
    return per_fold.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_folds"), *out)
