"""Run records and leaderboards.

A run table has one row per run: ``run_id, experiment, run_name,
start_time, end_time, params MAP<STRING,STRING>, metrics MAP<STRING,DOUBLE>,
tags MAP<STRING,STRING>`` (or plain metric columns).  "Latest" / "best" per
group is a ``max`` over a struct whose field order is the sort order - a
partial (map-side) aggregate, so a run name holding a third of all runs is
combined before the shuffle instead of being sorted in one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _pick(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], cols: Sequence[str]) -> DataFrame:
    """Per group, the row with the largest ``order`` tuple (lexicographic)."""
    key = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(c).alias(c) for c in cols])
    agg = df.groupBy(*group_cols).agg(F.max(key).alias("_best")) if group_cols else df.agg(F.max(key).alias("_best"))
    return agg.select(*group_cols, *[F.col(f"_best.{c}").alias(c) for c in cols])


def latest_per_name(runs: DataFrame, experiment: str | None = None, name_col: str = "run_name",
                    cols: Sequence[str] = ("run_id", "start_time", "metric")) -> DataFrame:
    """L1: newest run (``start_time``, then ``run_id``) per run name."""
    r = runs.where(F.col("experiment") == experiment) if experiment else runs
    return _pick(r, [name_col], [F.col("start_time"), F.col("run_id")], list(cols))


def search_runs(runs: DataFrame, where: Column, limit: int = 1) -> DataFrame:
    """L2: filter on tags / params, newest first, ``limit`` rows."""
    return runs.where(where).orderBy(F.desc("start_time"), F.desc("run_id")).limit(limit)


def preferred_or_fallback(runs: DataFrame, names: Sequence[str], group_cols: Sequence[str] = ("experiment",),
                          cols: Sequence[str] = ("run_id", "run_name", "start_time", "metric")) -> DataFrame:
    """L3: per group the newest run of the first name in ``names`` that has
    any run, else of the next one (priority, then newest, then run_id)."""
    prio = F.lit(None)
    for i, n in enumerate(names):
        prio = F.when(F.col("run_name") == n, F.lit(-i)).otherwise(prio) if i else F.when(F.col("run_name") == n, F.lit(0))
    r = runs.withColumn("_prio", prio).where(F.col("_prio").isNotNull())
    return _pick(r, list(group_cols), [F.col("_prio"), F.col("start_time"), F.col("run_id")], list(cols))


def best_run(runs: DataFrame, metric: str = "metric", ascending: bool = False, group_cols: Sequence[str] = ("experiment",),
             cols: Sequence[str] = ("run_id", "run_name", "metric")) -> DataFrame:
    """L4: run with the best metric per group (ties: smallest run_id, of any
    type; NULL and NaN metrics never win)."""
    m = F.col(metric).cast("double")
    r = runs.where(m.isNotNull() & ~F.isnan(m))
    # smallest (score, run_id) wins: partial aggregate, no sorted window
    score = m if ascending else -m
    key = F.struct(score.alias("_score"), F.col("run_id").alias("_id"), *[F.col(c).alias(c) for c in cols])
    g = list(group_cols)
    best = (r.groupBy(*g) if g else r).agg(F.min(key).alias("_best"))
    return best.select(*g, *[F.col(f"_best.{c}").alias(c) for c in cols])


def comparison_table(long: DataFrame, model: str, split: str, metrics: Sequence[str],
                     splits: Sequence[str] = ("val", "test"), digits: int = 4) -> DataFrame:
    """One row per model, ``<Split>_<metric>`` columns rounded; a model
    without rows is simply absent."""
    cols = []
    for s in splits:
        for m in metrics:
            cols.append(F.round(F.max(F.when(F.col(split) == s, F.col(m))), digits).alias(f"{s.capitalize()}_{m}"))
    return long.groupBy(F.col(model).alias("Model")).agg(*cols)


def champion(table: DataFrame, metric: str, champion_name: str, challenger_name: str) -> DataFrame:
    """The challenger replaces the champion when its metric is >= (ties
    go to the challenger)."""
    a = F.max(F.when(F.col("Model") == champion_name, F.col(metric)))
    b = F.max(F.when(F.col("Model") == challenger_name, F.col(metric)))
    out = table.agg(a.alias("champion_score"), b.alias("challenger_score"))
    win = F.when(F.col("challenger_score") >= F.col("champion_score"), F.lit(challenger_name)).otherwise(
        F.lit(champion_name))
    return out.withColumn("chosen", win)


def wide_summary(long: DataFrame, row: str, col: str, value: str, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Long ``(row, col, value)`` -> one row per ``row``, one column per
    listed ``col`` value (explicit pivot values: no extra distinct job)."""
    return (long.groupBy(row).pivot(col, list(columns)).agg(F.round(F.avg(value), digits)))


# ---------------------------------------------------------------- S5 / S4
RUN_SCHEMA = ("run_id string, experiment string, run_name string, start_time timestamp, end_time timestamp, "
              "params map<string,string>, metrics map<string,double>, tags map<string,string>")


def append_runs(runs: DataFrame, path: str) -> None:
    """Append run records to a parquet table partitioned by experiment
    (experiment = directory, so reads of one experiment prune the rest)."""
    runs.write.mode("append").partitionBy("experiment").parquet(path)


def read_runs(spark: SparkSession, path: str, experiment: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("experiment") == experiment) if experiment else df


def scan_tracking_store(spark: SparkSession, root: str) -> DataFrame:
    """Read a file-per-value tracking tree into one row per run.

    Layout: ``<exp>/meta.yaml`` (``name:``), ``<exp>/<run>/meta.yaml``
    (``start_time: <ms>``, ``end_time``, ``run_name``), and
    ``<exp>/<run>/{params,tags,metrics}/<name>``, where a name may have slashes;
    metric files hold lines ``<ts_ms> <value> <step>`` (the last by (step, ts)
    wins).  ``experiment`` is the name in the experiment's meta file, or its
    folder where there is none.  Other files (models, artifacts) are left out by
    a filter on the path, which Spark applies to the file listing; the rest are
    read in one job with ``wholetext``.
    """
    import re
    root = root.rstrip("/")
    bare = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:/+", "/", root).rstrip("/")         # scheme-less form of the root
    wanted = re.escape(bare) + r"/[^/]+/(meta\.yaml|[^/]+/(meta\.yaml|(params|tags|metrics)/.+))$"
    files = (spark.read.text(root, wholetext=True, recursiveFileLookup=True)
             .select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("path")).where(F.col("path").rlike(wanted)))
    parts = F.split(F.regexp_extract("path", re.escape(bare) + r"/(.*)$", 1), "/")
    f = files.select("body", F.get(parts, 0).alias("folder"), F.when(F.size(parts) > 2, F.get(parts, 1)).alias("run_id"),
                     F.coalesce(F.get(parts, 2), F.lit("meta.yaml")).alias("kind"),
                     F.array_join(F.slice(parts, 4, 1000), "/").alias("key"))
    names = f.where(F.col("run_id").isNull()).select("folder", F.nullif(F.regexp_extract("body", r"(?m)^name:\s*(.*?)\s*$", 1), F.lit("")).alias("_name"))
    f = (f.where(F.col("run_id").isNotNull()).join(names, "folder", "left")
         .withColumn("experiment", F.coalesce("_name", "folder")).drop("_name", "folder"))
    meta = f.where(F.col("kind") == "meta.yaml")
    def field(name):  # noqa: E306
        return F.regexp_extract("body", rf"(?m)^{name}:\s*(.*?)\s*$", 1)
    meta = meta.select("experiment", "run_id",
                       F.nullif(field("run_name"), F.lit("")).alias("run_name"),
                       F.timestamp_millis(F.nullif(field("start_time"), F.lit("")).try_cast("bigint")).alias("start_time"),
                       F.timestamp_millis(F.nullif(field("end_time"), F.lit("")).try_cast("bigint")).alias("end_time"))
    kv = f.where(F.col("kind").isin("params", "tags")).select(
        "experiment", "run_id", "kind", "key", F.regexp_replace("body", r"\s+$", "").alias("v"))
    maps = kv.groupBy("experiment", "run_id").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("kind") == "params", F.struct("key", "v")))).alias("params"),
        F.map_from_entries(F.collect_list(F.when(F.col("kind") == "tags", F.struct("key", "v")))).alias("tags"))
    lines = (f.where(F.col("kind") == "metrics")
             .select("experiment", "run_id", "key", F.explode(F.split(F.trim("body"), r"\n")).alias("line"))
             .select("experiment", "run_id", "key", F.split(F.trim("line"), r"\s+").alias("t")))
    t = F.col("t")
    pts = lines.select("experiment", "run_id", "key", F.get(t, 0).try_cast("bigint").alias("ts"),
                       F.get(t, 1).try_cast("double").alias("value"),
                       F.coalesce(F.get(t, 2).try_cast("bigint"), F.lit(0)).alias("step")).where(F.col("value").isNotNull())
    last = pts.groupBy("experiment", "run_id", "key").agg(
        F.max(F.struct("step", "ts", "value")).alias("_l"))
    mets = last.groupBy("experiment", "run_id").agg(
        F.map_from_entries(F.collect_list(F.struct("key", F.col("_l.value")))).alias("metrics"))
    return (meta.join(maps, ["experiment", "run_id"], "left").join(mets, ["experiment", "run_id"], "left")
            .select("run_id", "experiment", "run_name", "start_time", "end_time",
                    F.coalesce("params", F.create_map().cast("map<string,string>")).alias("params"),
                    F.coalesce("metrics", F.create_map().cast("map<string,double>")).alias("metrics"),
                    F.coalesce("tags", F.create_map().cast("map<string,string>")).alias("tags")))


def metrics_long(runs: DataFrame) -> DataFrame:
    """Run table -> ``(run_id, experiment, run_name, metric, value)``."""
    return runs.select("run_id", "experiment", "run_name", F.explode("metrics").alias("metric", "value"))
