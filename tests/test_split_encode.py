"""Splits, folds, encoders: properties and hand cases."""

from pyspark.sql import functions as F

from riskframe.operators import encode as ENC
from riskframe.operators import split as SPL
from riskframe.sources.tables import applications
from tests.conftest import SF_SMALL


def test_stratified_split_exact_sizes_and_disjoint(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 < 3, 2).otherwise(1).alias("y"))
    sp = SPL.stratified_split(df, "k", "y", seed=42)
    sizes = {r["split"]: r["count"] for r in sp.groupBy("split").count().collect()}
    assert sizes == {"train": 700, "val": 150, "test": 150}
    assert sp.select("k").distinct().count() == 1000
    mix = {(r["split"], r["y"]): r["n"] for r in SPL.split_audit(sp, "y").collect()}
    assert mix[("test", 2)] == 45 and mix[("val", 2)] == 45


def test_split_invariant_under_repartition(spark):
    a = applications(spark, SF_SMALL)
    one = {(r["app_id"], r["split"]) for r in SPL.stratified_split(a.repartition(1), "app_id", "class").collect()}
    many = {(r["app_id"], r["split"]) for r in SPL.stratified_split(a.repartition(7), "app_id", "class").collect()}
    assert one == many


def test_folds_balanced_per_class(spark):
    df = spark.range(103).select(F.col("id").alias("k"), (F.col("id") % 2).alias("y"))
    f = SPL.stratified_folds(df, "k", "y", k=5)
    sizes = [r["count"] for r in f.groupBy("fold", "y").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_label_encode_unseen_to_zero_and_sorted_levels(spark):
    train = spark.createDataFrame([("A42",), ("A410",), ("A40",)], "purpose string")
    levels = ENC.Levels.fit(train, ["purpose"])
    order = [r["level"] for r in levels.table.orderBy("ordinal").collect()]
    assert order == ["A40", "A410", "A42"] and levels.sizes == {"purpose": 3}          # binary string order
    test = spark.createDataFrame([(0, "A42"), (1, "A47"), (2, None)], "k int, purpose string")
    got = {r["k"]: r["purpose"] for r in ENC.label_encode(test, levels).collect()}
    assert got == {0: 2, 1: 0, 2: 0}


def test_one_hot_drop_first_unknown_all_zero(spark):
    levels = ENC.Levels.fit(spark.createDataFrame([("a",), ("b",), ("c",)], "c string"), ["c"])
    df = spark.createDataFrame([(1, "a"), (2, "c"), (3, "z"), (4, None)], "k int, c string")
    assert [tuple(r) for r in ENC.one_hot_entries(df, levels, "k").collect()] == [(2, "c_2", 1)]


def test_scaler_population_sd_and_zero_sd(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    p = ENC.fit_scaler(df, ["a", "b"])
    assert p.mean == {"a": 2.0, "b": 5.0} and p.scale == {"a": 1.0, "b": 1.0}


def test_one_hot_width_rule(spark):
    a = applications(spark, SF_SMALL)
    num, cat = ["total_price", "qty"], ["priority", "segment", "region"]
    prep = ENC.FittedPrep.fit(a, num, cat)
    n_levels = {c: a.select(c).distinct().count() for c in cat}
    assert len(prep.feature_names) == len(num) + sum(n - 1 for n in n_levels.values())


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(1,)] * 6 + [(2,)] * 2, "y int")
    w = {r["y"]: r["weight"] for r in ENC.class_weights(df, "y").collect()}
    assert w == {1: 8 / (2 * 6), 2: 8 / (2 * 2)}


def test_label_encode_shuffled_equals_broadcast(spark):
    train = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x")], "c1 string, c2 string")
    df = spark.createDataFrame([(1, "b", "y"), (2, "z", "x"), (3, None, "q")], "k int, c1 string, c2 string")
    levels = ENC.Levels.fit(train, ["c1", "c2"])
    for rows in (0, 100):
        got = sorted(tuple(r) for r in ENC.label_encode(df, levels, broadcast_rows=rows).collect())
        assert got == [(1, 1, 1), (2, 0, 0), (3, 0, 0)]


def test_thousands_of_levels(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.format_string("v%05d", "id").alias("c"), F.col("id").cast("double").alias("n"),
                                  F.lit("only").alias("one"))
    prep = ENC.FittedPrep.fit(df, ["n"], ["c", "one"])
    assert prep.n_features == len(prep.feature_names) == 5000
    v = {r["k"]: r["features"] for r in prep.transform_vector(df, ["k"]).where("k in (0, 1, 4999)").collect()}
    assert v[0].size == 5000 and [v[0][i] for i in range(1, 5000, 777)] == [0.0] * 7
    assert v[1][1] == 1.0 and v[4999][4999] == 1.0
    cells = {r["k"]: [(x["feature_index"], x["feature"]) for x in r["x"]] for r in prep.transform_cells(df, ["k"]).where("k in (0, 1, 4999)").collect()}
    assert cells == {0: [(0, "n")], 1: [(0, "n"), (1, "c_1")], 4999: [(0, "n"), (4999, "c_4999")]}


def test_hash_positions_equal_row_number_for_any_chunking(spark):
    from riskframe.functions.hashing import hash32
    from riskframe.functions.ranking import hash_positions
    df = spark.range(2000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("g"))
    want_df = df.withColumn("h", hash32("k", seed=7))
    want_df.createOrReplaceTempView("hp")
    want = {r["k"]: r["p"] for r in spark.sql(
        "SELECT k, row_number() OVER (PARTITION BY g ORDER BY h, k) - 1 AS p FROM hp").collect()}
    for bits in (1, 4, 12):
        got = {r["k"]: r["_pos"] for r in hash_positions(df, ["g"], "k", 7, chunk_bits=bits).collect()}
        assert got == want, bits


def test_vector_equals_cells(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 4.0), ("d", 9.0)], "c string, n double")
    df = spark.createDataFrame([(1, "a", 0.5), (2, "c", 4.0), (3, "z", 1.0), (4, None, 2.0), (5, "d", 9.0)], "k int, c string, n double")
    prep = ENC.FittedPrep.fit(train, ["n"], ["c"], [("n", "n")])
    vectors = {r["k"]: r["features"].toArray().tolist() for r in prep.transform_vector(df, ["k"]).collect()}
    for r in prep.transform_cells(df, ["k"]).collect():
        dense = [0.0] * prep.n_features
        for x in r["x"]:
            dense[x["feature_index"]] = x["value"]
            assert prep.feature_names[x["feature_index"]] == x["feature"]
        assert vectors[r["k"]] == dense


def test_rows_without_a_class_are_a_class(spark):
    from riskframe.functions.ranking import running_totals
    rows = [(i, i % 3 if i % 10 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, y int")
    sp = SPL.stratified_split(df, "k", "y")
    counts = {(r["y"], r["split"]): r["count"] for r in sp.groupBy("y", "split").count().collect()}
    assert sum(counts.values()) == 300 and sum(n for (y, _), n in counts.items() if y is None) == 30
    assert abs(counts[None, "test"] - 4.5) < 1 and sp.columns == ["k", "y", "split"]
    folds = SPL.stratified_folds(df, "k", "y", k=5)
    assert folds.where("y IS NULL").groupBy("fold").count().select("count").distinct().collect()[0][0] == 6 and folds.count() == 300
    totals = running_totals(df.withColumn("w", F.lit(1).cast("long")), ["y"], ["k"], "w", num_chunks=3)
    assert totals.count() == 300 and totals.where("y IS NULL").agg(F.max("_before")).first()[0] == 29
