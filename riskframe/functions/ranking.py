"""Exact global ranks, running totals and quantiles without one-task windows.

A window with ``orderBy`` and a low-cardinality (or no) ``partitionBy`` puts a
whole class, or the whole table, into one task.  Every rank-based operator
here (stratified splits, folds, exact percentiles, mid-rank AUC) instead:

1. cuts the ordered domain into *chunks* whose order matches the global
   order (hash-prefix chunks for md5 orders, range partitions otherwise),
2. ranks locally inside ``(group, chunk)`` - bounded pieces spread over
   all tasks,
3. adds a per-(group, chunk) offset computed from chunk totals; that table
   has at most ``groups x chunks`` rows.

The result equals ``row_number()`` / a running ``sum`` over the full group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.hashing import hash32
from riskframe.session import checkpoint


def _offsets(sizes: DataFrame, group_cols: Sequence[str], size_col: str) -> DataFrame:
    """Exclusive prefix sum of chunk sizes within each group (+ group total)."""
    g = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    before = g.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return (sizes
            .withColumn("_off", F.coalesce(F.sum(size_col).over(before), F.lit(0)).cast("long"))
            .withColumn("_total", F.sum(size_col).over(g).cast("long"))
            .drop(size_col))


def _grouped(df: DataFrame, group_cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The group columns as one struct ``_group``: a join on it also meets
    groups with NULL fields, which a join on the columns would drop."""
    return (df.withColumn("_group", F.struct(*group_cols)), ["_group"]) if group_cols else (df, [])


TARGET_CHUNK_ROWS = 2_000_000


def chunk_bits_for(df: DataFrame, group_cols: Sequence[str], lo: int = 6, hi: int = 20) -> int:
    """Bits of the md5 draw used as chunk id, so that the largest group
    splits into chunks of about ``TARGET_CHUNK_ROWS`` rows (one count job)."""
    import math
    g = list(group_cols)
    counts = df.groupBy(*g).count() if g else df.groupBy().count()
    n = counts.agg(F.max("count")).first()[0] or 0
    need = math.ceil(math.log2(max(n, 1) / TARGET_CHUNK_ROWS)) if n > TARGET_CHUNK_ROWS else 0
    return max(lo, min(hi, need))


def hash_positions(df: DataFrame, group_cols: Sequence[str], key_col: str, seed: int | str,
                   chunk_bits: int | None = None) -> DataFrame:
    """Add ``_h`` (md5 draw), ``_pos`` (0-based rank in ``(_h, key)`` order
    within ``group_cols``) and ``_total`` (group size).

    Chunks are the top ``chunk_bits`` bits of the draw, so chunk order is the
    global order and chunks are balanced by construction - no sampling, no
    checkpoint.  By default the bit count grows with the largest group
    (chunks of ~2M rows), so a class holding a third of the data is ranked
    by thousands of tasks.  Equals
    ``row_number() over (partition by g order by _h, key) - 1``.
    """
    group_cols = list(group_cols)
    if chunk_bits is None:
        chunk_bits = chunk_bits_for(df, group_cols)
    df, g = _grouped(df, group_cols)
    d = (df.withColumn("_h", hash32(key_col, seed=seed))
         .withColumn("_chunk", F.shiftright(F.col("_h"), 32 - chunk_bits).cast("int")))
    sizes = d.groupBy(*g, "_chunk").agg(F.count(F.lit(1)).alias("_cn"))
    offs = _offsets(sizes, g, "_cn")
    local = Window.partitionBy(*g, "_chunk").orderBy("_h", key_col)
    ranked = d.withColumn("_local", F.row_number().over(local) - 1)
    return (ranked.join(offs, [*g, "_chunk"])
            .withColumn("_pos", (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_chunk", "_local", "_off", "_group"))


def running_totals(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], weight_col: str,
                   num_chunks: int | None = None) -> DataFrame:
    """Add ``_before`` (sum of ``weight_col`` over rows strictly earlier in
    ``order_cols`` within the group) and ``_total`` (group sum).

    Rows must be unique on ``group_cols + order_cols`` (callers pre-aggregate
    ties into weights, which also removes key skew).  Chunks are range
    partitions; the partitioned data is checkpointed to shared storage so that
    the local ranks and the chunk totals see the same sampled bounds.  A
    table of at most ``TARGET_CHUNK_ROWS`` rows (checked by a count) is one
    chunk and uses a plain window per group.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    spark = df.sparkSession
    # the input (usually a compact pre-aggregate) is read by the count, the
    # range-bound sampling and the partitioned write: materialise it once
    df = checkpoint(df)
    if num_chunks is None:
        import math
        rows = df.count()
        if rows <= TARGET_CHUNK_ROWS:
            # size-checked small case: the whole table is at most one chunk,
            # so an ordinary window per group is bounded by the check
            g = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
            before = g.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
            return (df.withColumn("_before", F.coalesce(F.sum(weight_col).over(before), F.lit(0)).cast("long"))
                    .withColumn("_total", F.sum(weight_col).over(g).cast("long")))
        # otherwise at least the shuffle width, and enough range partitions
        # that each local window sorts about TARGET_CHUNK_ROWS rows
        num_chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / TARGET_CHUNK_ROWS))
    n = num_chunks
    ranged = checkpoint(df.repartitionByRange(n, *group_cols, *order_cols)
                        .withColumn("_chunk", F.spark_partition_id()))
    ranged, g = _grouped(ranged, group_cols)
    sizes = ranged.groupBy(*g, "_chunk").agg(F.sum(weight_col).alias("_cw"))
    offs = _offsets(sizes, g, "_cw")
    local = (Window.partitionBy(*g, "_chunk").orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cum = ranged.withColumn("_cum", F.sum(weight_col).over(local))
    return (cum.join(offs, [*g, "_chunk"])
            .withColumn("_before", (F.col("_off") + F.col("_cum") - F.col(weight_col)).cast("long"))
            .drop("_chunk", "_cum", "_off", "_group"))


def value_counts(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """``(group..., value, _w)`` with NULL values removed (map-side combined)."""
    return (df.where(F.col(value_col).isNotNull())
            .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_w")))


def quantile_columns(ranked_counts: DataFrame, value_col: str, probs: Sequence[float],
                     names: Sequence[str]) -> list[Column]:
    """Aggregate expressions giving exact linear-interpolated quantiles
    (numpy ``linear`` / SQL ``quantile_cont``) from the output of
    :func:`running_totals` over :func:`value_counts`."""
    v = F.col(value_col).cast("double")
    before, w, total = F.col("_before"), F.col("_w"), F.col("_total")
    out = []
    for p, name in zip(probs, names):
        h = F.lit(float(p)) * (total - 1)
        lo = F.floor(h)
        hi = F.ceil(h)
        at_lo = F.max(F.when((before <= lo) & (lo < before + w), v))
        at_hi = F.max(F.when((before <= hi) & (hi < before + w), v))
        frac = F.max(h - lo)
        out.append((at_lo + (at_hi - at_lo) * frac).alias(name))
    return out
