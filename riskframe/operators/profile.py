"""Profiling / EDA operators (P1-P14): single-pass aggregations.

Wide-to-long reshapes use ``unpivot`` (an Expand feeding a partial
aggregate), so one scan serves every column instead of one job per column.
Exact quantiles use the distributed ranking in ``functions.ranking``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType

from riskframe.functions.ranking import quantile_columns, running_totals, value_counts
from riskframe.roles import APPLICATION_ROLES, Roles

NUMERIC_TYPES = (IntegerType, LongType, DoubleType, FloatType)


def _long(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (), name: str = "feature",
          value: str = "value", cast: str = "double") -> DataFrame:
    sel = df.select(*ids, *[F.col(c).cast(cast).alias(c) for c in cols])
    return sel.unpivot(list(ids), list(cols), name, value)


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def column_info(df: DataFrame) -> DataFrame:
    """Per column: position, Spark type name, non-null count (one scan)."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column_name", "non_null")
    dtypes = F.create_map(*[x for f in df.schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    pos = F.create_map(*[x for i, f in enumerate(df.schema.fields) for x in (F.lit(f.name), F.lit(i))])
    return long.select(pos[F.col("column_name")].alias("position"), "column_name",
                       dtypes[F.col("column_name")].alias("dtype"), "non_null")


def dtype_counts(df: DataFrame) -> DataFrame:
    """P2 (histogram part): number of columns per Spark type."""
    return column_info(df).groupBy("dtype").agg(F.count(F.lit(1)).alias("n_columns"))


def missing_report(df: DataFrame) -> DataFrame:
    """NULL count and percentage per column, only columns with NULLs,
    largest first, with the grand total of missing cells on every row."""
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = agg.unpivot(["_n"], df.columns, "column_name", "n_missing")
    kept = long.where(F.col("n_missing") > 0)
    return (kept.select("column_name", "n_missing",
                        F.round(F.lit(100.0) * F.col("n_missing") / F.col("_n"), 4).alias("pct_missing"),
                        F.sum("n_missing").over(Window.partitionBy(F.lit(0))).alias("total_missing"))
            .orderBy(F.desc("n_missing"), "column_name"))


def numeric_columns(df: DataFrame) -> list[str]:
    """P5: names of int / bigint / double / float columns, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def select_numeric(df: DataFrame) -> DataFrame:
    """P5: projection to the numeric-typed columns."""
    return df.select(*numeric_columns(df))


def describe(df: DataFrame, cols: Sequence[str], digits: int = 4, exact: bool = True,
             accuracy: int = 10000) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (exact, linear), max.

    ``exact=False`` is the opt-in for continuous columns of extreme
    cardinality: ``percentile_approx`` (a bounded sketch per group, rank
    error about 1/``accuracy``) instead of the exact value-count ranking."""
    long = _long(df, cols)
    if not exact:
        q = F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy)
        return (long.groupBy("feature").agg(
            F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"), q.alias("_q"), F.max("value").alias("max"))
            .select("feature", "count", *[F.round(c, digits).alias(c) for c in ("mean", "std", "min")],
                    *[F.round(F.col("_q")[i], digits).alias(n) for i, n in enumerate(("q25", "q50", "q75"))],
                    F.round("max", digits).alias("max")))
    moments = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    rc = running_totals(value_counts(long, ["feature"], "value"), ["feature"], ["value"], "_w")
    qs = rc.groupBy("feature").agg(*quantile_columns(rc, "value", [0.25, 0.5, 0.75], ["q25", "q50", "q75"]))
    out = moments.join(qs, "feature", "left")
    return out.select("feature", "count", *[F.round(c, digits).alias(c)
                                           for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


def class_distribution(df: DataFrame, roles: Roles = APPLICATION_ROLES) -> DataFrame:
    """Class value, label text, count and percentage."""
    counts = df.groupBy(roles.label).agg(F.count(F.lit(1)).alias("n"))
    text = F.when(F.col(roles.label) == roles.negative, roles.label_text[roles.negative]).otherwise(
        roles.label_text[roles.positive])
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))   # over the per-class rows only
    return counts.select(roles.label, text.alias("label_text"), "n",
                         F.round(F.lit(100.0) * F.col("n") / total, 4).alias("pct"))


def imbalance_ratio(df: DataFrame, roles: Roles = APPLICATION_ROLES) -> DataFrame:
    """n(negative) / n(positive), NULL when there are no positives."""
    y = F.col(roles.label)
    return df.agg(
        F.count_if(y == roles.negative).alias("n_majority"), F.count_if(y == roles.positive).alias("n_minority"),
        F.round(F.try_divide(F.count_if(y == roles.negative).cast("double"),
                             F.count_if(y == roles.positive).cast("double")), 6).alias("imbalance_ratio"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows, distinct rows, rows after the first copy (NULLs compare equal)."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return groups.agg(F.sum("_c").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"),
                      F.sum(F.col("_c") - 1).alias("n_duplicates"))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 20, digits: int = 4) -> DataFrame:
    """Equal-width histogram per column, last bin right-closed, empty bins
    kept, min == max gives a single bin."""
    long = _long(df, cols).where(F.col("value").isNotNull())
    rng = long.groupBy("feature").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    span = F.col("mx") - F.col("mn")
    b = F.when(span == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("value") - F.col("mn")) * bins / span).cast("int") + 1, F.lit(bins)))
    # rng has one row per column: broadcast, the unpivoted rows are not shuffled
    counts = long.join(F.broadcast(rng), "feature").groupBy("feature", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select("feature", "mn", "mx",
                      F.explode(F.sequence(F.lit(1), F.when(span == 0, 1).otherwise(bins))).alias("bin"))
    width = F.when(span == 0, F.lit(0.0)).otherwise(span / bins)
    return (grid.join(counts, ["feature", "bin"], "left")
            .select("feature", F.col("bin").cast("int").alias("bin"),
                    F.round(F.col("mn") + (F.col("bin") - 1) * width, digits).alias("lo"),
                    F.round(F.when(span == 0, F.col("mx")).otherwise(F.col("mn") + F.col("bin") * width), digits).alias("hi"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def boxplot_by_class(df: DataFrame, cols: Sequence[str], roles: Roles = APPLICATION_ROLES,
                     digits: int = 4, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """P10: q1, median, q3, mean, Tukey whiskers (furthest datum within
    1.5 IQR), outlier count and notch interval ``median +- 1.57 IQR / sqrt(n)``
    per (feature, class).

    One scan builds value counts per (feature, class, value); quantiles,
    whiskers and outliers are then computed on that compact table.
    """
    long = _long(df, cols, ids=[roles.label])
    g = ["feature", roles.label]
    v, w = F.col("value"), F.col("_w")
    if exact:
        rc = running_totals(value_counts(long, g, "value"), g, ["value"], "_w")
        stats = rc.groupBy(*g).agg(
            F.sum("_w").alias("n"), (F.sum(v * w) / F.sum(w)).alias("mean_w"),
            *quantile_columns(rc, "value", [0.25, 0.5, 0.75], ["q1", "median", "q3"]))
    else:
        # opt-in for extreme cardinality: bounded sketches instead of exact ranks
        rc = value_counts(long, g, "value")
        q = F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy)
        stats = (long.where(v.isNotNull()).groupBy(*g)
                 .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_w"), q.alias("_q"))
                 .select(*g, "n", "mean_w", *[F.col("_q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]))
    iqr = F.col("q3") - F.col("q1")
    stats = stats.withColumn("lo_fence", F.col("q1") - 1.5 * iqr).withColumn("hi_fence", F.col("q3") + 1.5 * iqr)
    # stats has one row per (feature, class): broadcast
    tails = rc.join(F.broadcast(stats.select(*g, "lo_fence", "hi_fence")), g).groupBy(*g).agg(
        F.min(F.when(v >= F.col("lo_fence"), v)).alias("whisker_lo"),
        F.max(F.when(v <= F.col("hi_fence"), v)).alias("whisker_hi"),
        F.sum(F.when((v < F.col("lo_fence")) | (v > F.col("hi_fence")), w).otherwise(0)).alias("n_outliers"))
    out = stats.join(tails, g)
    notch = 1.57 * iqr / F.sqrt(F.col("n"))
    r = lambda c, name: F.round(c, digits).alias(name)
    return out.select("feature", roles.label, "n", r(F.col("q1"), "q1"), r(F.col("median"), "median"),
                      r(F.col("q3"), "q3"), r(F.col("mean_w"), "mean"), r(F.col("whisker_lo"), "whisker_lo"),
                      r(F.col("whisker_hi"), "whisker_hi"), F.col("n_outliers").cast("long").alias("n_outliers"),
                      r(F.col("median") - notch, "notch_lo"), r(F.col("median") + notch, "notch_hi"))


def _varying(df: DataFrame, cols: Sequence[str]) -> set[str]:
    """Columns with non-zero population variance (one small aggregation).

    ``corr`` divides by the standard deviations and raises under ANSI when
    one is zero, so pairs involving a constant column are answered with
    NULL without evaluating ``corr`` at all."""
    row = df.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return {c for i, c in enumerate(cols) if row[f"s{i}"] is not None and row[f"s{i}"] > 0}


def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson r for every ordered pair from one aggregation (each
    unordered pair computed once); diagonal is 1, zero variance gives NULL."""
    cols = list(cols)
    ok = _varying(df, cols)
    x = {c: F.col(c).cast("double") for c in cols}
    pair_alias = {(a, b): f"r{i}_{j}" for i, a in enumerate(cols) for j, b in enumerate(cols)
                  if i < j and a in ok and b in ok}
    aggs = [F.corr(x[a], x[b]).alias(n) for (a, b), n in pair_alias.items()] or [F.count(F.lit(1)).alias("_n")]
    wide = df.agg(*aggs)
    cells = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                r = F.lit(1.0) if a in ok else F.lit(None)
            elif (a, b) in pair_alias or (b, a) in pair_alias:
                r = F.col(pair_alias[(a, b) if i < j else (b, a)])
                r = F.when(F.isnan(r), F.lit(None)).otherwise(r)
            else:
                r = F.lit(None)
            cells.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), r.cast("double").alias("r")))
    return (wide.select(F.explode(F.array(*cells)).alias("c"))
            .select("c.x", "c.y", F.round("c.r", digits).alias("r")))


def distinct_levels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of distinct non-NULL levels per categorical column."""
    long = _long(df, cols, name="column_name", value="level", cast="string")
    return (long.where(F.col("level").isNotNull()).distinct()
            .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_levels")))


SKETCH_BITS = 14        # standard error 1.04 / sqrt(2^14) = 0.8 %


def distinct_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), bits: int = SKETCH_BITS) -> DataFrame:
    """P12 for huge data: ``(by.., column_name, sketch)``, a mergeable distinct
    count (HyperLogLog) of every column, as a table that can be kept per
    partition and grows by appending.  One aggregation without a fan-out of
    rows; NULLs are not counted."""
    named = [F.hll_sketch_agg(F.col(c).cast("string"), bits).alias(c) for c in cols]
    wide = df.groupBy(*by).agg(*named)
    return wide.unpivot(list(by), list(cols), "column_name", "sketch")


def distinct_estimates(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by.., column_name, n_estimated)`` of sketches united over all other
    keys: no row of the table is read again."""
    return sketches.groupBy(*by, "column_name").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_estimated"))


def target_correlation_ranking(df: DataFrame, cols: Sequence[str], roles: Roles = APPLICATION_ROLES,
                               digits: int = 6) -> DataFrame:
    """r(feature, target) ordered by |r| descending."""
    y = F.col(roles.label).cast("double")
    ok = _varying(df, [*cols, roles.label])
    wide = df.agg(*[(F.corr(F.col(c).cast("double"), y) if c in ok and roles.label in ok
                     else F.lit(None).cast("double")).alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "feature", "r")
    r = F.when(F.isnan("r"), F.lit(None)).otherwise(F.col("r"))
    long = long.select("feature", F.round(r, digits).alias("r"))
    return (long.withColumn("abs_r", F.abs("r"))
            .withColumn("rank", F.row_number().over(
                Window.partitionBy(F.lit(0)).orderBy(F.desc_nulls_last("abs_r"), "feature")))
            .orderBy("rank"))


def bad_rate_by_level(df: DataFrame, cols: Sequence[str], cutoffs: dict[str, object],
                      roles: Roles = APPLICATION_ROLES, min_support: int = 1, digits: int = 6) -> DataFrame:
    """Share of the positive (bad) class by category level and by
    boolean cut-offs, with support, in one unpivot + one aggregation."""
    flags = {name: F.when(cond, "true").otherwise("false") for name, cond in cutoffs.items()}
    sel = df.select(roles.label, *[F.col(c).cast("string").alias(c) for c in cols],
                    *[v.alias(k) for k, v in flags.items()])
    long = sel.unpivot([roles.label], [*cols, *flags], "dimension", "level")
    bad = (F.col(roles.label) == roles.positive).cast("int")
    out = long.groupBy("dimension", "level").agg(F.count(F.lit(1)).alias("n"), F.sum(bad).cast("long").alias("n_bad"))
    return (out.where(F.col("n") >= min_support)
            .withColumn("bad_rate", F.round(F.col("n_bad") / F.col("n"), digits)))
