"""Hand-computed metric cases (FIXTURES.md §3 and SURVEY §5.2)."""

import math

from pyspark.sql import functions as F

from riskframe.operators import metrics as V


def _pred(spark, rows, schema="y int, p double"):
    return spark.createDataFrame(rows, schema)


def test_auc_with_ties_hand_case(spark):
    # y=[1,1,2,2,2], p=[.1,.5,.5,.8,.2] -> AUC = 4.5 / 6
    df = _pred(spark, [(1, .1), (1, .5), (2, .5), (2, .8), (2, .2)])
    r = V.roc_auc(df, y="y", score="p").first()
    assert r["roc_auc"] == round(4.5 / 6, 6)
    assert (r["n_pos"], r["n_neg"]) == (3, 2)


def test_auc_single_class_is_null(spark):
    df = _pred(spark, [(2, .1), (2, .9)])
    assert V.roc_auc(df, y="y", score="p").first()["roc_auc"] is None


def test_threshold_counts_hand_case(spark):
    df = _pred(spark, [(1, .1), (1, .5), (2, .5), (2, .8), (2, .2)]).withColumn(
        "yhat", F.when(F.col("p") > 0.4, 2).otherwise(1))
    r = V.classification_metrics(df, y="y").first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (2, 1, 1, 1)
    assert r["precision_pos2"] == r["recall_pos2"] == r["f1_pos2"] == round(2 / 3, 6)


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "y int, yhat int")
    r = V.classification_metrics(df, y="y").first()
    assert r["precision_pos2"] == 0.0 and r["recall_pos2"] == 0.0 and r["f1_pos2"] == 0.0
    assert r["accuracy"] == 1.0


def test_confusion_grid_keeps_zero_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "class int, yhat int")
    cells = {(r["actual"], r["predicted"]): r["n"] for r in V.confusion_long(df).collect()}
    assert cells == {(1, 1): 2, (1, 2): 0, (2, 1): 0, (2, 2): 0}


def test_weighted_f1_matches_definition(spark):
    rows = [(1, 1), (1, 2), (2, 2), (2, 2), (2, 1), (1, 1)]
    df = spark.createDataFrame(rows, "class int, yhat int")
    r = V.classification_metrics(df).first()

    def f1(pos):
        tp = sum(1 for y, h in rows if y == pos and h == pos)
        fp = sum(1 for y, h in rows if y != pos and h == pos)
        fn = sum(1 for y, h in rows if y == pos and h != pos)
        return 2 * tp / (2 * tp + fp + fn)
    sup1 = sum(1 for y, _ in rows if y == 1)
    want = (f1(1) * sup1 + f1(2) * (len(rows) - sup1)) / len(rows)
    assert r["f1_weighted"] == round(want, 6)


def test_auc_equals_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.choice([1, 2]), round(rnd.random(), 1)) for _ in range(300)]   # many ties
    pos = [p for y, p in rows if y == 2]
    neg = [p for y, p in rows if y == 1]
    brute = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    got = V.roc_auc(_pred(spark, rows, "y int, p double"), y="y", score="p").first()["roc_auc"]
    assert got == round(brute, 6)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (2.0, 2.0)], "y double, yhat double")
    r = V.regression_metrics(df, "y", "yhat").first()
    assert r["mae"] == round((0.5 + 1 + 0) / 3, 6)
    assert r["rmse"] == round(math.sqrt((0.25 + 1) / 3), 6)
    mean = 5 / 3
    sst = sum((y - mean) ** 2 for y in (1, 2, 2))
    assert r["r2"] == round(1 - 1.25 / sst, 6)


def test_expected_cost(spark):
    df = spark.createDataFrame([(2, 1), (1, 2), (1, 1), (2, 2)], "class int, yhat int")
    r = V.expected_cost(df, V.cost_table(spark)).first()
    assert r["total_cost"] == 6.0 and r["cost_per_row"] == 1.5


def test_threshold_sweep_argmin(spark):
    df = _pred(spark, [(1, .1), (1, .5), (2, .5), (2, .8), (2, .2)], "class int, p double")
    out = {r["threshold"]: r for r in V.threshold_sweep(df, [0.5, 0.4, 0.1]).collect()}
    assert (out[0.5]["fn"], out[0.5]["fp"]) == (2, 0)
    assert (out[0.4]["fn"], out[0.4]["fp"]) == (1, 1)
    assert (out[0.1]["fn"], out[0.1]["fp"]) == (0, 1)
    assert [t for t, r in out.items() if r["is_best"]] == [0.1]


def test_ntile_bands_match_sql_ntile(spark):
    df = spark.range(23).select(F.col("id").alias("key"), (F.col("id") % 5).cast("double").alias("v"))
    got = {r["key"]: r["band"] for r in V.ntile_bands(df, "v", "key", 4).collect()}
    df.createOrReplaceTempView("nt")
    want = {r["key"]: r["b"] for r in spark.sql("SELECT key, ntile(4) OVER (ORDER BY v, key) AS b FROM nt").collect()}
    assert got == want


def test_permutation_importance_zero_for_unused_feature(spark):
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"),
                                 F.when(F.col("id") % 7 > 3, 2).otherwise(1).alias("y"))
    out = {r["feature"]: r for r in V.permutation_importance(df, "k", "y", {"a": 1, "b": 0}, -3.5, repeats=3).collect()}
    assert out["b"]["importance_mean"] == 0.0
    assert out["a"]["importance_mean"] > 0.2


def test_linear_score_inline_equals_join(spark):
    df = spark.range(50).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("a"),
                                (F.col("id") % 3).cast("double").alias("b"))
    coefs = V.coefficient_table(spark, {"a": 0.5, "b": -2.0}, 1.25)
    inline = {r["k"]: r["z"] for r in V.score_linear(df, "k", coefs).collect()}
    joined = {r["k"]: r["z"] for r in V.score_linear(df, "k", coefs, max_inline=1).collect()}
    assert inline.keys() == joined.keys()
    assert all(abs(inline[k] - joined[k]) < 1e-12 for k in inline)
    assert inline[3] == 1.25 + 0.5 * 3 - 2.0 * 0


def test_running_totals_chunked_equals_window(spark):
    from riskframe.functions.ranking import running_totals
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 3001).alias("v"),
                                  (F.col("id") % 5 + 1).alias("w"))
    small = {(r["g"], r["v"]): (r["_before"], r["_total"]) for r in running_totals(df, ["g"], ["v"], "w").collect()}
    chunked = {(r["g"], r["v"]): (r["_before"], r["_total"])
               for r in running_totals(df, ["g"], ["v"], "w", num_chunks=7).collect()}
    assert small == chunked and len(small) == 3000
