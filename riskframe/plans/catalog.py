"""Named queries: one entry per operator of the survey inventory.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables (or data Spark derives from them).  ``riskframe.plans.oracle``
holds the independent SQL text for the same key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import profile as P
from riskframe.roles import APPLICATION_ROLES as ROLES
from riskframe.sources.tables import applications

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


NUM = list(ROLES.numeric)
CAT = list(ROLES.categorical)


# ---------------------------------------------------------------- profiling
@query("p1_shape")
def _p1(spark, sf):
    return P.shape(applications(spark, sf))


@query("p2_column_info")
def _p2(spark, sf):
    return P.column_info(applications(spark, sf, coalesce_lines=False))


@query("p2_dtype_counts")
def _p2b(spark, sf):
    return P.dtype_counts(applications(spark, sf))


@query("p3_missing_report")
def _p3(spark, sf):
    return P.missing_report(applications(spark, sf, coalesce_lines=False))


@query("p4_describe")
def _p4(spark, sf):
    return P.describe(applications(spark, sf), NUM)


@query("p5_select_numeric")
def _p5(spark, sf):
    return P.select_numeric(applications(spark, sf))


@query("p6_class_distribution")
def _p6(spark, sf):
    return P.class_distribution(applications(spark, sf))


@query("p7_imbalance_ratio")
def _p7(spark, sf):
    return P.imbalance_ratio(applications(spark, sf))


@query("p8_duplicate_rows")
def _p8(spark, sf):
    return P.duplicate_rows(applications(spark, sf).drop("app_id"))      # whole rows but for the key


@query("p8_duplicate_rows_few_columns")
def _p8b(spark, sf):
    return P.duplicate_rows(applications(spark, sf).select("priority", "segment", "region", "class"))


@query("p9_histogram")
def _p9(spark, sf):
    return P.histogram(applications(spark, sf), NUM, bins=20)


@query("p10_boxplot_by_class")
def _p10(spark, sf):
    return P.boxplot_by_class(applications(spark, sf), NUM)


@query("p11_correlation_matrix")
def _p11(spark, sf):
    return P.correlation_matrix(applications(spark, sf), NUM + ["class"])


@query("p12_distinct_levels")
def _p12(spark, sf):
    return P.distinct_levels(applications(spark, sf), CAT)


SKETCHED = ("app_id", "total_price", "acct_balance", *CAT)


@query("p12_distinct_sketch_checked")
def _p12b(spark, sf):
    """Distinct counts from sketches kept per year and united, next to the exact
    ones: within four standard errors (3.3 %)."""
    apps = materialise(applications(spark, sf).select(*SKETCHED), "applications")
    kept = materialise(P.distinct_sketches(apps, [c for c in SKETCHED if c != "order_year"], ["order_year"]), "sketches")
    exact = P.distinct_levels(apps, [c for c in SKETCHED if c != "order_year"])
    off = F.abs(F.col("n_estimated") - F.col("n_levels")) / F.col("n_levels")
    return (exact.join(P.distinct_estimates(kept), "column_name")
            .select("column_name", "n_levels", (off <= 4 * 1.04 / 2 ** (P.SKETCH_BITS / 2)).alias("estimate_ok")))


@query("p13_target_correlation")
def _p13(spark, sf):
    return P.target_correlation_ranking(applications(spark, sf), NUM)


@query("p14_bad_rate_by_level")
def _p14(spark, sf):
    cut = {"total_price>250000": F.col("total_price") > 250000, "qty>100": F.col("qty") > 100}
    return P.bad_rate_by_level(applications(spark, sf), CAT, cut, min_support=30)


# ---------------------------------------------------------------- shared derived frames
from riskframe.functions import exprs as X  # noqa: E402
from riskframe.operators import encode as ENC  # noqa: E402
from riskframe.operators import split as SPL  # noqa: E402
from riskframe.sources.tables import application_labels, read_table, scored  # noqa: E402
from riskframe.session import materialise  # noqa: E402

SEED = 42
def unseen_fit():
    """FIXTURES "unseen level" case: the vocabulary is fitted on these rows."""
    return F.col("order_year") < "Y2000"


def split_apps(spark, sf, raw: bool = False):
    """Applications with their T1 split.  The view (a lineitem aggregate and
    four joins) is read by every job of the split - sizes, cut counts and
    ranks - so it is written once to the shared folder, by column."""
    apps = materialise(applications(spark, sf, coalesce_lines=not raw), "applications")
    return SPL.stratified_split(apps, "app_id", "class", seed=SEED)


def split_labels(spark, sf, **options):
    """Key, class and split, from the two columns that a split needs."""
    labels = materialise(application_labels(spark, sf), "labels")
    return SPL.assign_split(labels, "app_id", seed=SEED, **({"group_cols": ["class"]} | options))


def train_prep(spark, sf):
    """(split frame, FittedPrep fitted on the train split)."""
    sp = materialise(split_apps(spark, sf), "split")      # read by the fit jobs and the query
    prep = ENC.FittedPrep.fit(sp.where(F.col("split") == "train"), NUM, CAT)
    return sp, prep


# ---------------------------------------------------------------- expressions
@query("e1_drop_label")
def _e1(spark, sf):
    return applications(spark, sf).drop(ROLES.label)


@query("e2_cast_report")
def _e2(spark, sf):
    a = applications(spark, sf).select("priority", "top_flag", F.col("n_lines").cast("string").alias("n_lines"),
                                       F.substring("order_year", 2, 4).alias("year_digits"))
    return X.cast_report(a, ["priority", "top_flag", "n_lines", "year_digits"], "int")


@query("e3_conjunctive_filter")
def _e3(spark, sf):
    a = applications(spark, sf)
    return (a.where((F.col("class") == 2) & F.col("total_price").between(100000, 300000)
                    & (F.col("segment") == "BUILDING"))
            .select("app_id", "total_price", "segment", "class"))


@query("e4_membership")
def _e4(spark, sf):
    a = applications(spark, sf, coalesce_lines=False)
    learnt = a.where(unseen_fit()).select("order_year").distinct()
    return (a.where(F.col("priority").isin("1-URGENT", "2-HIGH") & F.col("n_lines").isNotNull())
            .join(learnt, "order_year", "left_semi")
            .select("app_id", "priority", "order_year", "n_lines"))


@query("e4_unseen_levels")
def _e4b(spark, sf):
    a = applications(spark, sf)
    vocab = ENC.vocabulary(a.where(unseen_fit()), CAT).select("column_name", "level")
    long = a.select(*CAT).unpivot([], CAT, "column_name", "level")
    # count per level first (map-side combined, so a hot level is one row),
    # then anti-join the distinct levels against the vocabulary
    per_level = long.groupBy("column_name", "level").agg(F.count(F.lit(1)).alias("n_rows"))
    return per_level.join(vocab, ["column_name", "level"], "left_anti")


@query("e5_threshold_label")
def _e5(spark, sf):
    s = scored(spark, sf)
    return s.select("app_id", "p", X.threshold_label("p", 0.5).alias("label_05"),
                    X.threshold_label("p", 0.4).alias("label_04"))


@query("e8_feature_names")
def _e8(spark, sf):
    train = split_apps(spark, sf).where(F.col("split") == "train")
    return ENC.vocabulary(train, CAT).where(F.col("ordinal") > 0)


@query("e9_array_functions")
def _e9(spark, sf):
    # a small per-row integer tuple (like a layer-size tuple): its length is
    # bounded by construction (at most 3), never by a group of rows
    a = applications(spark, sf)
    layers = F.filter(F.array((F.col("n_lines") * 16).cast("int"), F.col("cust_orders").cast("int"), F.lit(8)),
                      lambda v: v > 0)
    arr = a.select("app_id", layers.alias("layers"))
    text = X.tuple_text("layers")
    return arr.select("app_id", F.size("layers").alias("n_layers"), X.array_total("layers").alias("total_units"),
                      text.alias("layers_text"), (X.parse_tuple_text(text) == F.col("layers")).alias("roundtrip_ok"))


@query("e10_math_functions")
def _e10(spark, sf):
    s = scored(spark, sf)
    return s.select("app_id", F.abs("z").alias("abs_z"), F.round(F.sqrt(F.abs("z")), 6).alias("sqrt_abs_z"),
                    F.round(F.pow("z", 2), 6).alias("z_sq"))


def runs_view(spark, sf):
    """Runs-shaped view over ``events`` (FIXTURES.md §5)."""
    ev = read_table(spark, sf, "events")
    return ev.select(
        F.col("event_id").alias("run_id"),
        F.when(F.col("user_id") % 2 == 0, "base").otherwise("tuned").alias("experiment"),
        F.col("event_type").alias("run_name"), F.col("ts").alias("start_time"),
        F.col("value").alias("metric"), F.from_json("props", "map<string,string>").alias("params"))


@query("e11_epoch_ms_duration")
def _e11(spark, sf):
    r = runs_view(spark, sf).withColumn("ms", X.ts_to_epoch_ms("start_time"))
    g = r.groupBy("experiment", "run_name").agg(F.min("ms").alias("start_ms"), F.max("ms").alias("end_ms"))
    # duration from the round trip ms -> timestamp -> seconds
    dur = (X.epoch_ms_to_ts("end_ms").cast("double") - X.epoch_ms_to_ts("start_ms").cast("double"))
    return g.select("experiment", "run_name", "start_ms", "end_ms", F.round(dur, 3).alias("duration_s"))


# ---------------------------------------------------------------- splits
@query("t1_stratified_split")
def _t1(spark, sf):
    return split_labels(spark, sf).select("app_id", "class", "split")


@query("t2_random_split")
def _t2(spark, sf):
    return split_labels(spark, sf, group_cols=[]).select("app_id", "class", "split")


@query("t3_stratified_folds")
def _t3(spark, sf):
    labels = materialise(application_labels(spark, sf), "labels")
    return SPL.stratified_folds(labels, "app_id", "class", k=5, seed=SEED).select("app_id", "class", "fold")


@query("t4_pool_train_val")
def _t4(spark, sf):
    return SPL.pool(split_labels(spark, sf)).select("app_id", "class", "split")


@query("t5_split_audit")
def _t5(spark, sf):
    return SPL.split_audit(split_labels(spark, sf), "class")


@query("t5_split_overlap")
def _t5b(spark, sf):
    return SPL.split_overlap(split_labels(spark, sf), "app_id")


# ---------------------------------------------------------------- encoders
@query("f1_label_encode")
def _f1(spark, sf):
    a = materialise(applications(spark, sf).select("app_id", *CAT), "levels")     # read by the vocabulary jobs and the joins
    return ENC.label_encode(a, ENC.Levels.fit(a.where(unseen_fit()), CAT))


@query("f2_one_hot_drop_first")
def _f2(spark, sf):
    a = materialise(applications(spark, sf).select("app_id", *CAT), "levels")     # read by the vocabulary jobs and the joins
    return ENC.one_hot_entries(a, ENC.Levels.fit(a.where(unseen_fit()), CAT), "app_id")


def many_levels(spark, sf):
    """Orders with a text column of thousands of levels; fitted on those of
    before 1998, so that later days are unseen."""
    o = read_table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("order_day"),
                                               F.col("o_custkey").cast("string").alias("customer"))
    return o, ENC.Levels.fit(o.where(F.col("order_day") < "1998-01-01"), ["order_day", "customer"])


@query("f1_label_encode_many_levels")
def _f1b(spark, sf):
    return ENC.label_encode(*many_levels(spark, sf))


@query("f2_one_hot_many_levels")
def _f2b(spark, sf):
    return ENC.one_hot_entries(*many_levels(spark, sf), "o_orderkey")


@query("f3_standard_scale")
def _f3(spark, sf):
    sp = split_apps(spark, sf)
    params = ENC.fit_scaler(sp.where(F.col("split") == "train"), NUM)
    sc = ENC.scaled_columns(params)
    return sp.select("app_id", *[F.round(sc[c], 6).alias(c) for c in NUM])


@query("f4_interaction")
def _f4(spark, sf):
    return applications(spark, sf).select("app_id", F.round(ENC.interaction("n_lines", "max_discount"), 6)
                                          .alias("n_lines_x_max_discount"))


@query("f5_assemble")
def _f5(spark, sf):
    sp, prep = train_prep(spark, sf)
    x = prep.transform_cells(sp, ["app_id"])
    return x.select("app_id", F.lit(prep.n_features).alias("n_features"), F.size("x").alias("n_nonzero"),
                    F.round(F.aggregate("x.value", F.lit(0.0), lambda acc, v: acc + F.abs(v)), 4).alias("l1_norm"))


@query("f6_tree_prep")
def _f6(spark, sf):
    sp = split_apps(spark, sf)
    return ENC.tree_prep(sp, ENC.Levels.fit(sp.where(F.col("split") == "train"), CAT), NUM, keep=["app_id"])


@query("f7_linear_prep")
def _f7(spark, sf):
    sp, prep = train_prep(spark, sf)
    out = prep.transform_sparse(sp, "app_id")
    return out.select("app_id", "feature_index", "feature", F.round("value", 6).alias("value"))


@query("f8_class_weights")
def _f8(spark, sf):
    train = split_apps(spark, sf).where(F.col("split") == "train")
    return ENC.with_class_weight(train.select("app_id", "class"), "class").select(
        "app_id", "class", F.round("weight", 6).alias("weight"))

import riskframe.plans.q_metrics  # noqa: E402,F401  (registers M12/M13/V*)

import riskframe.plans.q_tune  # noqa: E402,F401  (registers G*)

import riskframe.plans.q_runs  # noqa: E402,F401  (registers L*)

import riskframe.plans.q_sources  # noqa: E402,F401  (registers S*)

import riskframe.plans.q_neighbors  # noqa: E402,F401  (registers R*, L9)

import riskframe.plans.q_models  # noqa: E402,F401  (registers M*, S6, S7, G2, G3, G11, L8)

import riskframe.plans.q_checks  # noqa: E402,F401  (registers the facts about fitted models)


# ---------------------------------------------------------------- second labelled source (labels x documents)
def labelled_documents(spark, sf):
    """``labels`` joined to ``documents`` (FIXTURES: the 341:58 imbalance case)."""
    lab = read_table(spark, sf, "labels")
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return lab.join(docs, "doc_id")


@query("p7_imbalance_ratio_labels")
def _p7b(spark, sf):
    from riskframe.roles import Roles
    roles = Roles(numeric=("n_chars",), categorical=("lang",), label="quality", key="doc_id",
                  positive=0, negative=1, label_text={1: "good", 0: "low"})
    return P.imbalance_ratio(labelled_documents(spark, sf), roles)


@query("f8_class_weights_labels")
def _f8b(spark, sf):
    return ENC.class_weights(labelled_documents(spark, sf), "quality").select(
        "quality", "n_c", F.round("weight", 6).alias("weight"))
