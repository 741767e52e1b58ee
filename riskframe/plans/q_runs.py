"""Catalog entries for run records and leaderboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import metrics as V
from riskframe.operators import runs as R
from riskframe.plans.catalog import query, runs_view, split_apps
from riskframe.plans.q_tune import CV_MODELS, _z
from riskframe.session import checkpoint, scratch_path
from riskframe.sources.tracking import run_values, write_values


@query("l1_latest_run_per_name")
def _l1(spark, sf):
    return R.latest_per_name(runs_view(spark, sf), experiment="base")


@query("l2_search_runs")
def _l2(spark, sf):
    r = runs_view(spark, sf)
    hit = R.search_runs(r, (F.col("run_name") == "purchase") & (F.col("params")["k"] == "42"), limit=1)
    return hit.select("run_id", "run_name", "start_time", "metric", F.col("params")["k"].alias("k"))


@query("l3_preferred_or_fallback")
def _l3(spark, sf):
    # hours without a purchase fall back to the next name
    r = runs_view(spark, sf).withColumn("hour", F.date_trunc("hour", "start_time"))
    return R.preferred_or_fallback(r, ["purchase", "signup"], ["experiment", "hour"])


@query("s4_tracking_scan")
def _s4(spark, sf):
    """Events as daily runs with hourly history, written as a tracking tree and
    scanned back; the metric's name has a slash, the run id is text."""
    r = runs_view(spark, sf).withColumn("start_time", F.col("start_time").cast("timestamp")).withColumn("day", F.to_date("start_time"))
    g = ["experiment", "run_name", "day"]
    hourly = r.groupBy(*g, F.hour("start_time").alias("step")).agg(F.max("metric").alias("value"), F.max(F.unix_millis("start_time")).alias("ts_ms"),
                                                                   F.min("start_time").alias("lo"), F.max("start_time").alias("hi"))
    points = F.collect_list(F.struct("ts_ms", "value", "step"))      # at most 24 a run
    runs = hourly.groupBy(*g).agg(points.alias("p"), F.min("lo").alias("start_time"), F.max("hi").alias("end_time"))
    runs = runs.select("experiment", F.concat_ws("_", F.lit("run"), "run_name", F.date_format("day", "yyyyMMdd")).alias("run_id"), "run_name",
                       "start_time", "end_time", F.create_map(F.lit("day"), F.col("day").cast("string")).alias("params"),
                       F.create_map(F.lit("kind"), F.col("run_name")).alias("tags"), F.create_map(F.lit("val/value"), F.col("p")).alias("history"))
    root = scratch_path(spark, "tracking")
    write_values(run_values(runs), root)
    back = R.scan_tracking_store(spark, root)
    return back.select("run_id", "experiment", "run_name", F.unix_millis("start_time").alias("start_ms"), F.unix_millis("end_time").alias("end_ms"),
                       F.col("params")["day"].alias("day"), F.col("tags")["kind"].alias("kind"), F.col("metrics")["val/value"].alias("value"))


@query("l4_best_run")
def _l4(spark, sf):
    return R.best_run(runs_view(spark, sf), "metric", ascending=False)


@query("l4_best_run_asc")
def _l4b(spark, sf):
    return R.best_run(runs_view(spark, sf), "metric", ascending=True)


def model_split_metrics(spark, sf):
    """(model, split, accuracy, f1, roc_auc) of the named scorers on val/test."""
    sp = split_apps(spark, sf).where(F.col("split").isin("val", "test"))
    arr = F.array(*[F.struct(F.lit(m).alias("model"), _z(wb, wq, d).alias("zd"), F.lit(t).alias("t"))
                    for m, (wb, wq, d, t) in CV_MODELS.items()])
    pred = (sp.select("app_id", "class", "split", F.explode(arr).alias("m"))
            .select("app_id", "class", "split", "m.model",
                    F.round(1 / (1 + F.exp(-F.col("m.zd").cast("double"))), 6).alias("p"), "m.t"))
    pred = checkpoint(pred.withColumn("yhat", F.when(F.col("p") > F.col("t"), 2).otherwise(1)))
    g = ["model", "split"]
    cls = V.classification_metrics(pred, group_cols=g, digits=12)
    auc = V.roc_auc(pred, group_cols=g, digits=12).select(*g, "roc_auc")
    return cls.join(auc, g).select(*g, "accuracy", F.col("f1_pos2").alias("f1"), "roc_auc")


@query("l4_best_run_text_ids")
def _l4c(spark, sf):
    """Text run ids, and a run whose metric is not a number in every group."""
    r = runs_view(spark, sf).withColumn("run_id", F.concat(F.lit("run-"), F.col("run_id").cast("string")))
    nan = r.groupBy("experiment").agg(F.lit("run-nan").alias("run_id"), F.lit("none").alias("run_name"), F.lit(float("nan")).alias("metric"))
    return R.best_run(r.select("experiment", "run_id", "run_name", "metric").unionByName(nan.select("experiment", "run_id", "run_name", "metric")), "metric")


@query("l5_comparison_table")
def _l5(spark, sf):
    return R.comparison_table(model_split_metrics(spark, sf), "model", "split", ["accuracy", "f1", "roc_auc"])


@query("l6_champion")
def _l6(spark, sf):
    t = R.comparison_table(model_split_metrics(spark, sf), "model", "split", ["accuracy", "f1", "roc_auc"])
    return R.champion(t, "Val_f1", "base", "low_threshold")


@query("l7_wide_summary")
def _l7(spark, sf):
    return R.wide_summary(runs_view(spark, sf), "run_name", "experiment", "metric", ["base", "tuned"])
