"""Scalar expression helpers (E2-E11), all built-in Spark functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def try_number(c, to: str = "int") -> Column:
    """String -> number; dirty input gives NULL instead of an ANSI error."""
    return F.expr(f"try_cast({c} AS {to})") if isinstance(c, str) else c.try_cast(to)


def cast_report(df: DataFrame, cols: Sequence[str], to: str = "int") -> DataFrame:
    """Per column, how many non-NULL strings cast cleanly / are rejected."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column_name", "raw")
    parsed = F.col("raw").try_cast(to)
    return (long.where(F.col("raw").isNotNull())
            .groupBy("column_name")
            .agg(F.count(parsed).alias("n_ok"), F.count_if(parsed.isNull()).alias("n_rejected"),
                 F.sum(parsed).cast("long").alias("sum_ok")))


def threshold_label(p, threshold: float = 0.5, positive: int = 2, negative: int = 1) -> Column:
    """E5: strict ``p > t`` gives the positive class (``(p > 0.5) + 1``)."""
    return F.when(as_col(p) > F.lit(threshold), F.lit(positive)).otherwise(F.lit(negative))


def round_all(df: DataFrame, digits: int = 4, exclude: Sequence[str] = ()) -> DataFrame:
    """Round every floating column (Spark rounds HALF_UP; numpy rounds
    half-to-even, which only differs on exact ties)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float") and f.name not in exclude:
            out.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def relative_improvement(base, best, lower_is_better: bool = True, digits: int = 4) -> tuple[Column, Column]:
    """Percentage change of ``best`` against ``base`` and a text verdict.

    For an error metric the gain is (base - best) / base * 100; for a score it
    is (best - base) / base * 100.  Sign decides the wording.
    """
    base, best = as_col(base), as_col(best)
    gain = (base - best) if lower_is_better else (best - base)
    pct = F.round(F.try_divide(gain * 100.0, F.abs(base)), digits)
    text = (F.when(pct > 0, F.format_string(f"%.{digits}f%% better", pct))
            .when(pct < 0, F.format_string(f"%.{digits}f%% worse", F.abs(pct)))
            .otherwise(F.lit("no change")))
    return pct, text


def tuple_text(arr) -> Column:
    """Render an int array the way a tuple prints: ``(64, 32)``."""
    return F.concat(F.lit("("), F.array_join(as_col(arr), ", "), F.lit(")"))


def parse_tuple_text(text) -> Column:
    """Parse ``(64, 32)`` back to ARRAY<INT> without eval."""
    return F.from_json(F.translate(as_col(text), "()", "[]"), "array<int>")


def array_total(arr) -> Column:
    """Sum of an int array with a higher-order function."""
    return F.aggregate(as_col(arr), F.lit(0).cast("long"), lambda acc, x: acc + x)


def epoch_ms_to_ts(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP."""
    return F.timestamp_millis(as_col(ms))


def ts_to_epoch_ms(ts) -> Column:
    """Wall-clock TIMESTAMP_NTZ -> epoch milliseconds (floor), independent of
    the session time zone (microseconds since the NTZ epoch, then // 1000)."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                              as_col(ts).cast("timestamp_ntz"))
    return F.floor(micros / 1000).cast("long")
