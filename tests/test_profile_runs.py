"""Profiling edge cases, tracking-store scan and leaderboards."""

import os

from pyspark.sql import functions as F

from riskframe.operators import profile as P
from riskframe.operators import runs as R
from riskframe.operators import tune as G
from riskframe.sources import csv_io as C


def test_histogram_edges_and_single_bin(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 1.0), (5.0, 1.0)], "a double, b double")
    h = {(r["feature"], r["bin"]): r["n"] for r in P.histogram(df, ["a", "b"], bins=4).collect()}
    assert h[("a", 1)] == 1 and h[("a", 3)] == 1 and h[("a", 4)] == 1 and h[("a", 2)] == 0   # max in last bin
    assert [k for k in h if k[0] == "b"] == [("b", 1)] and h[("b", 1)] == 3


def test_boxplot_whiskers_and_outliers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v, 1) for v in vals], "x double, class int")
    r = P.boxplot_by_class(df, ["x"]).first()
    assert (r["q1"], r["median"], r["q3"]) == (2.0, 3.0, 4.0)
    assert r["whisker_hi"] == 4.0 and r["n_outliers"] == 1


def test_missing_report_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    m = P.missing_report(df).collect()
    assert [(r["column_name"], r["n_missing"]) for r in m] == [("b", 2)]
    d = P.duplicate_rows(df).first()
    assert (d["n_rows"], d["n_distinct"], d["n_duplicates"]) == (3, 2, 1)


def test_correlation_zero_variance_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    cells = {(r["x"], r["y"]): r["r"] for r in P.correlation_matrix(df, ["a", "b"]).collect()}
    assert cells[("a", "a")] == 1.0 and cells[("b", "b")] is None and cells[("a", "b")] is None


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_tracking_store_scan(spark, tmpdir_path):
    root = tmpdir_path
    _write(f"{root}/e1/meta.yaml", "name: exp\n")
    _write(f"{root}/e1/r1/meta.yaml", "run_name: baseline\nstart_time: 1700000000000\nend_time: 1700000001385\n")
    _write(f"{root}/e1/r1/params/C", "1.0")
    _write(f"{root}/e1/r1/tags/run.name", "baseline")
    _write(f"{root}/e1/r1/metrics/val_roc_auc", "1700000000500 0.70 0\n1700000000900 0.78 1\n")
    _write(f"{root}/e1/r2/meta.yaml", "run_name: tuned\nstart_time: 1700000005000\nend_time: 1700000006000\n")
    _write(f"{root}/e1/r2/metrics/val_roc_auc", "1700000005500 0.80 0\n")
    _write(f"{root}/e1/r2/metrics/val/f1", "1700000005500 0.5 0\n")          # a name with a slash
    _write(f"{root}/e1/models/m-1/artifacts/MLmodel", "run_name: no run\n")
    _write(f"{root}/e2/r3/meta.yaml", "run_name: lone\nstart_time: 1700000007000\nend_time: 1700000008000\n")  # no experiment file
    runs = {r["run_id"]: r for r in R.scan_tracking_store(spark, root).collect()}
    assert {k: r["experiment"] for k, r in runs.items()} == {"r1": "exp", "r2": "exp", "r3": "e2"}
    assert runs["r2"]["metrics"] == {"val_roc_auc": 0.8, "val/f1": 0.5}
    assert runs["r1"]["params"] == {"C": "1.0"} and runs["r1"]["metrics"] == {"val_roc_auc": 0.78}
    dur = (runs["r1"]["end_time"] - runs["r1"]["start_time"]).total_seconds()
    assert abs(dur - 1.385) < 1e-9
    latest = R.latest_per_name(R.scan_tracking_store(spark, root).withColumn("metric", F.col("metrics")["val_roc_auc"]),
                               experiment="exp").collect()
    assert {r["run_name"] for r in latest} == {"baseline", "tuned"}


def test_csv_roundtrip_failfast(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "credit.csv")
    with open(p, "w") as fh:
        fh.write(",".join(n for n, _ in C.CREDIT_COLUMNS) + "\n")
        fh.write("A11,6,A34,A43,1169,A65,A75,4,A93,A101,4,A121,67,A143,A152,2,A173,1,A192,A201,1\n")
        fh.write("A12,48,A32,A410,5951,A61,A73,2,A92,A101,2,A121,22,A143,A152,1,A173,1,A191,A201,2\n")
    df = C.read_credit_csv(spark, p)
    rows = df.orderBy("duration_months").collect()
    assert [r["class"] for r in rows] == [1, 2] and rows[1]["purpose"] == "A410"
    with open(p, "a") as fh:
        fh.write("A13,notanumber,A32,A42,1,A61,A73,2,A92,A101,2,A121,22,A143,A152,1,A173,1,A191,A201,2\n")
    try:
        C.read_credit_csv(spark, p).collect()
        raise AssertionError("FAILFAST should reject the dirty row")
    except Exception as exc:  # noqa: BLE001
        assert "AssertionError" not in type(exc).__name__


def test_grid_ids_and_impact_null_policy(spark):
    g = G.param_grid(spark, {"a": [1, 2], "b": [None, "x", "y"]})
    rows = g.orderBy("config_id").collect()
    assert [(r["a"], r["b"]) for r in rows][:3] == [(1, None), (1, "x"), (1, "y")] and rows[-1]["n_configs"] == 6
    res = g.withColumn("m", F.col("config_id").cast("double"))
    keep = {(r["param"], r["value"]) for r in G.param_impact(res, ["a", "b"], "m").collect()}
    drop = {(r["param"], r["value"]) for r in G.param_impact(res, ["a", "b"], "m", keep_null=False).collect()}
    assert ("b", None) in keep and ("b", None) not in drop


def test_right_closed_bins_keep_empty(spark):
    df = spark.createDataFrame([(50.0, 1.0), (51.0, 2.0), (300.0, 3.0)], "u double, m double")
    out = {r["bin"]: (r["n"], r["mean_m"]) for r in G.binned_summary(df, "u", [0, 50, 100, 150, 300], "m").collect()}
    assert out == {"(0, 50]": (1, 1.0), "(50, 100]": (1, 2.0), "(100, 150]": (0, None), "(150, 300]": (1, 3.0)}


def test_competition_rank(spark):
    df = spark.createDataFrame([("a", 0.9), ("b", 0.9), ("c", 0.8)], "model string, s double")
    assert sorted((r["model"], r["rank"]) for r in G.competition_rank(df, "s", "model").collect()) == \
        [("a", 1), ("b", 1), ("c", 3)]


def test_describe_approx_close_to_exact(spark):
    df = spark.range(1000).select((F.col("id") * 1.0).alias("v"))
    ex = P.describe(df, ["v"]).first()
    ap = P.describe(df, ["v"], exact=False).first()
    assert ex["count"] == ap["count"] == 1000 and ex["mean"] == ap["mean"]
    for q in ("q25", "q50", "q75"):
        assert abs(ex[q] - ap[q]) <= 2.0


def test_boxplot_approx_close_to_exact(spark):
    df = spark.range(2000).select((F.col("id") % 97 * 1.0).alias("x"), (F.col("id") % 2 + 1).cast("int").alias("class"))
    ex = {r["class"]: r for r in P.boxplot_by_class(df, ["x"]).collect()}
    ap = {r["class"]: r for r in P.boxplot_by_class(df, ["x"], exact=False).collect()}
    for c in (1, 2):
        assert ex[c]["n"] == ap[c]["n"] and ex[c]["mean"] == ap[c]["mean"]
        assert abs(ex[c]["median"] - ap[c]["median"]) <= 1.0


def test_distinct_sketches_unite(spark):
    rows = [(i % 4, i, i % 7, None if i % 2 else "x") for i in range(20_000)] + [(9, 5, 5, None)] * 30
    df = spark.createDataFrame(rows, "part int, a int, b int, c string").repartition(6)
    kept = P.distinct_sketches(df, ["a", "b", "c"], ["part"])
    assert kept.count() == 15
    got = {r["column_name"]: r["n_estimated"] for r in P.distinct_estimates(kept).collect()}
    assert abs(got["a"] - 20_000) < 0.04 * 20_000 and (got["b"], got["c"]) == (7, 1)
    per = {(r["part"], r["column_name"]): r["n_estimated"] for r in P.distinct_estimates(kept, ["part"]).collect()}
    assert per[9, "a"] == 1 and per[9, "c"] == 0 and abs(per[0, "a"] - 5000) < 200
