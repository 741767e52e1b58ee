"""Exact, reproducible splits and folds.

Row order inside a class is the md5 draw of ``(key, seed)``; cut counts are
computed exactly per class (largest remainder), so class shares are kept to
within one row - unlike ``sampleBy`` / ``randomSplit``, which are Bernoulli.
A split compares each row's draw with its class's two cut points, found from
a histogram of the draws, so the rows are not shuffled.  Folds need ranks:
``functions.ranking.hash_positions`` (chunked, no one-task window).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.hashing import hash32
from riskframe.functions.ranking import hash_positions

SPLITS = ("train", "val", "test")


def _allocate(counts: DataFrame, group_cols: Sequence[str], total_col: str, fraction: float, out: str) -> DataFrame:
    """Give ``ceil(fraction * N)`` rows to groups in proportion to ``total_col``
    by largest remainder (ties: lower group key first).  ``counts`` has one
    row per group (e.g. per class), so the windows here are over a tiny table.
    """
    everything = Window.partitionBy(F.lit(0))
    n_all = F.sum(total_col).over(everything)
    target = F.ceil(F.round(F.lit(float(fraction)) * n_all, 9))
    c = counts.withColumn("_target", target.cast("long"))
    c = c.withColumn("_quota", F.col("_target") * F.col(total_col) / n_all)
    c = c.withColumn("_base", F.floor("_quota").cast("long"))
    c = c.withColumn("_left", F.col("_target") - F.sum("_base").over(everything))
    order = everything.orderBy(F.desc(F.col("_quota") - F.col("_base")), *group_cols)
    c = c.withColumn("_extra", (F.row_number().over(order) <= F.col("_left")).cast("long"))
    return c.withColumn(out, F.col("_base") + F.col("_extra")).drop("_target", "_quota", "_base", "_left", "_extra")


def cut_counts(df: DataFrame, group_cols: Sequence[str], test_size: float = 0.15, val_size: float = 0.15) -> DataFrame:
    """Per group: ``n``, ``n_test``, ``n_val`` (test first, then
    ``val / (1 - test)`` of the rest)."""
    group_cols = list(group_cols)
    counts = (df.groupBy(*group_cols) if group_cols else df.groupBy()).agg(F.count(F.lit(1)).alias("n"))
    counts = _allocate(counts, group_cols, "n", test_size, "n_test")
    counts = counts.withColumn("_rest", F.col("n") - F.col("n_test"))
    counts = _allocate(counts, group_cols, "_rest", val_size / (1 - test_size), "n_val")
    return counts.drop("_rest")


CUT_BITS = 16


def cut_points(df: DataFrame, group_cols: Sequence[str], key: str, seed: int, counts: DataFrame) -> DataFrame:
    """Per group, the draws ``(_h, key)`` of the first row after the test part
    (``_cut1``) and after the validation part (``_cut2``); NULL where no row is
    left.  A histogram of the draws' upper bits finds the chunk that holds a
    cut; only that chunk's rows are ranked."""
    g = list(group_cols)
    d = df.select(*g, F.col(key).alias("_key"), hash32(key, seed=seed).alias("_h"))
    d = d.withColumn("_chunk", F.shiftright("_h", 32 - CUT_BITS).cast("int"))
    sizes = d.groupBy(*g, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*g).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)     # one row per chunk
    sizes = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    targets = F.explode(F.array(F.struct(F.lit(1).alias("which"), F.col("n_test").alias("at")),
                                F.struct(F.lit(2).alias("which"), (F.col("n_test") + F.col("n_val")).alias("at"))))
    wanted = counts.select(*g, targets.alias("_t")).select(*g, F.col("_t.which").alias("_which"), F.col("_t.at").alias("_at"))
    hit = (sizes.join(F.broadcast(wanted), g).where((F.col("_off") <= F.col("_at")) & (F.col("_at") < F.col("_off") + F.col("_n")))
           .select(*g, "_chunk", "_which", (F.col("_at") - F.col("_off")).alias("_rest")))
    # two rows per group: broadcast, so that the rows of other chunks stay where they are
    rank = F.row_number().over(Window.partitionBy(*g, "_which").orderBy("_h", "_key")) - 1
    cut = d.join(F.broadcast(hit), [*g, "_chunk"]).withColumn("_i", rank).where(F.col("_i") == F.col("_rest"))
    at = F.struct("_h", "_key")
    found = cut.groupBy(*g).agg(F.max(F.when(F.col("_which") == 1, at)).alias("_cut1"), F.max(F.when(F.col("_which") == 2, at)).alias("_cut2"))
    return counts.select(*g).join(found, g, "left")


def assign_split(df: DataFrame, key: str, group_cols: Sequence[str] = (), seed: int = 42,
                 test_size: float = 0.15, val_size: float = 0.15, col: str = "split") -> DataFrame:
    """T1 (stratified when ``group_cols`` = [label]) / T2 (no groups): rows are
    compared with their group's two cut points, so they are not shuffled.  The
    cut points have one row per group (class) and are broadcast.  Rows whose
    class is NULL are a class of their own (a group is a struct, whose NULL
    fields are equal in joins)."""
    g = ["_group"]
    rows = df.withColumn("_group", F.struct(*group_cols) if group_cols else F.struct(F.lit(0)))
    cuts = cut_points(rows, g, key, seed, cut_counts(rows, g, test_size, val_size))
    at = F.struct(hash32(key, seed=seed).alias("_h"), F.col(key).alias("_key"))
    split = (F.when(F.col("_cut1").isNull() | (at < F.col("_cut1")), "test")
             .when(F.col("_cut2").isNull() | (at < F.col("_cut2")), "val").otherwise("train"))
    return rows.join(F.broadcast(cuts), g).withColumn(col, split).drop("_cut1", "_cut2", "_group")


def stratified_split(df: DataFrame, key: str, label: str, seed: int = 42, test_size: float = 0.15,
                     val_size: float = 0.15) -> DataFrame:
    """Exact class-preserving train / val / test."""
    return assign_split(df, key, [label], seed, test_size, val_size)


def random_split(df: DataFrame, key: str, seed: int = 42, test_size: float = 0.15, val_size: float = 0.15) -> DataFrame:
    """Exact-size train / val / test without stratification."""
    return assign_split(df, key, [], seed, test_size, val_size)


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42, col: str = "fold") -> DataFrame:
    """fold = rank within class (md5 order) mod k, so every fold gets
    floor or ceil of n_c / k rows of each class (NULL is a class of its own)."""
    ranked = hash_positions(df, [label], key, f"fold{seed}")
    return ranked.withColumn(col, F.pmod(F.col("_pos"), F.lit(k)).cast("int")).drop("_h", "_pos", "_total")


def pool(df: DataFrame, splits: Sequence[str] = ("train", "val"), col: str = "split") -> DataFrame:
    """T4: rows of the given splits together (one filter, no copies)."""
    return df.where(F.col(col).isin(list(splits)))


def split_audit(df: DataFrame, label: str, col: str = "split") -> DataFrame:
    """T5: rows and class mix per split."""
    by = df.groupBy(col, label).agg(F.count(F.lit(1)).alias("n"))
    share = F.round(F.col("n") / F.sum("n").over(Window.partitionBy(col)), 6)
    return by.withColumn("class_share", share)


def split_overlap(df: DataFrame, key: str, col: str = "split") -> DataFrame:
    """T5 disjointness: keys found in more than one split (must be empty)."""
    return (df.groupBy(key).agg(F.countDistinct(col).alias("n_splits"))
            .where(F.col("n_splits") > 1))
