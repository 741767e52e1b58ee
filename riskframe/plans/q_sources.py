"""Catalog entries for sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import profile as P
from riskframe.operators import runs as R
from riskframe.plans.catalog import query, runs_view
from riskframe.session import scratch_path
from riskframe.sources import csv_io as C
from riskframe.sources.tables import applications


@query("s1_csv_scan")
def _s1(spark, sf):
    """S2 then S1: applications written as header CSV, read back typed."""
    path = scratch_path(spark, "apps-csv")
    C.write_csv(applications(spark, sf), path)
    return C.read_csv(spark, path, C.APPLICATION_SCHEMA)


@query("s2_csv_sink")
def _s2(spark, sf):
    path = scratch_path(spark, "class-dist-csv")
    C.write_csv(P.class_distribution(applications(spark, sf)), path)
    return C.read_csv(spark, path, "class int, label_text string, n bigint, pct double")


@query("s3_concat_by_key")
def _s3(spark, sf):
    a = applications(spark, sf)
    return C.concat_by_key(a.drop("class"), a.select("app_id", "class"), "app_id")


@query("s5_append_runs")
def _s5(spark, sf):
    """Run records appended to a table partitioned by experiment (two
    appends), then one experiment read back with partition pruning."""
    r = runs_view(spark, sf)
    rec = r.select(F.col("run_id").cast("string").alias("run_id"), "experiment", "run_name", "start_time",
                   F.col("start_time").alias("end_time"), "params",
                   F.create_map(F.lit("value"), F.col("metric")).alias("metrics"),
                   F.create_map(F.lit("source"), F.lit("events")).alias("tags"))
    path = scratch_path(spark, "runs")
    R.append_runs(rec.where(F.col("run_name") != "view"), path)
    R.append_runs(rec.where(F.col("run_name") == "view"), path)
    back = R.read_runs(spark, path, "base")
    return (R.metrics_long(back).groupBy("run_name", "metric")
            .agg(F.count(F.lit(1)).alias("n_runs"), F.round(F.sum("value"), 4).alias("total")))
