"""Train-fitted encoders and scalers (F1-F8).

The fitted vocabulary is a table ``(column_name, level, ordinal)`` and stays
one: rows get their ordinals by a hash join on the level, whatever the number
of levels.  The driver only learns the number of levels per column, which
gives every feature its index; up to ``BROADCAST_ROWS`` levels the join gets a
broadcast hint, beyond that Spark shuffles.  Scaler parameters are one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import checkpoint

BROADCAST_ROWS = 100_000


def vocabulary(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, level, ordinal, feature_name)``; ordinal is the
    0-based rank in sorted level order (UTF-8 binary), learnt on train only.

    Levels are distinct per column, so the ordinal is a running count in
    level order - computed by the chunked running totals, which stay
    parallel even for a column with very many levels."""
    from riskframe.functions.ranking import running_totals
    long = (train.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], list(cols), "column_name", "level")
            .where(F.col("level").isNotNull()).distinct()
            .withColumn("_one", F.lit(1).cast("long")))
    ranked = running_totals(long, ["column_name"], ["level"], "_one")
    return (ranked.select("column_name", "level", F.col("_before").cast("int").alias("ordinal"))
            .withColumn("feature_name", F.concat_ws("_", "column_name", F.col("ordinal").cast("string"))))


@dataclass
class Levels:
    """A fitted vocabulary: its table and the number of levels per column."""
    table: DataFrame
    sizes: dict[str, int]

    @classmethod
    def fit(cls, train: DataFrame, cols: Sequence[str]) -> "Levels":
        return cls.of(checkpoint(vocabulary(train, cols).drop("feature_name")), cols)   # read by every join

    @classmethod
    def of(cls, table: DataFrame, cols: Sequence[str]) -> "Levels":
        found = {r["column_name"]: r["n"] for r in table.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}
        return cls(table, {c: found.get(c, 0) for c in cols})

    def join(self, df: DataFrame, prefix: str = "_ord_", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
        """Add ``<prefix><column>``: the ordinal of the row's level, NULL where
        the level was not learnt."""
        for c, n in self.sizes.items():
            v = self.table.where(F.col("column_name") == c).select(F.col("level").alias("_lv"), F.col("ordinal").alias(f"{prefix}{c}"))
            v = F.broadcast(v) if n <= broadcast_rows else v
            df = df.join(v, F.col(c).cast("string") == F.col("_lv"), "left").drop("_lv")
        return df


def label_encode(df: DataFrame, levels: Levels, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """the columns of ``levels`` as ordinals, unseen or NULL -> 0."""
    coded = levels.join(df, broadcast_rows=broadcast_rows)
    return coded.select(*[F.coalesce(f"_ord_{c}", F.lit(0)).cast("int").alias(c) if c in levels.sizes else F.col(c) for c in df.columns])


def one_hot_entries(df: DataFrame, levels: Levels, key: str) -> DataFrame:
    """F2, drop-first, as its non-zero entries ``(key, feature, value)``; the
    first level, unseen levels and NULL have none."""
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"_ord_{c}").alias("o")) for c in levels.sizes])
    return (levels.join(df).select(key, F.explode(F.filter(cells, lambda x: x["o"] > 0)).alias("x"))
            .select(key, F.concat_ws("_", "x.c", F.col("x.o").cast("string")).alias("feature"), F.lit(1).alias("value")))


def one_hot_names(sizes: dict[str, int]) -> list[str]:
    """The feature name of every non-first level, in feature order."""
    return [f"{c}_{i}" for c, n in sizes.items() for i in range(1, n)]


@dataclass
class ScalerParams:
    mean: dict[str, float]
    scale: dict[str, float]


def fit_scaler(train: DataFrame, cols: Sequence[str]) -> ScalerParams:
    """population mean / std (ddof 0) on train; zero std -> 1."""
    row = train.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    mean = {c: row[f"m{i}"] for i, c in enumerate(cols)}
    scale = {c: (row[f"s{i}"] if row[f"s{i}"] else 1.0) for i, c in enumerate(cols)}
    return ScalerParams(mean, scale)


def scaled_columns(params: ScalerParams) -> dict[str, Column]:
    return {c: ((F.col(c).cast("double") - F.lit(params.mean[c])) / F.lit(params.scale[c])) for c in params.mean}


def interaction(a: str, b: str) -> Column:
    """raw (unscaled) product of two numeric columns, by name."""
    return (F.col(a).cast("double") * F.col(b).cast("double")).alias(f"{a}_x_{b}")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """F8: balanced weights n / (k * n_c), one row per class (k rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    everything = Window.partitionBy(F.lit(0))          # over the k class rows only
    w = F.sum("n_c").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n_c"))
    return counts.withColumn("weight", w)


def with_class_weight(df: DataFrame, label: str, col: str = "weight") -> DataFrame:
    """F8: per-row weight column (join to the k-row weight table, broadcast)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(col))
    return df.join(F.broadcast(w), label)   # k rows: bounded by the number of classes


@dataclass
class FittedPrep:
    """fitted linear-model preparation (scaled numerics ++ drop-first
    one-hot [++ interactions]).  Fit on train, apply to any split."""
    numeric: list[str]
    categorical: list[str]
    levels: Levels
    scaler: ScalerParams
    interactions: list[tuple[str, str]] = field(default_factory=list)

    @classmethod
    def fit(cls, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
            interactions: Sequence[tuple[str, str]] = ()) -> "FittedPrep":
        return cls(list(numeric), list(categorical), Levels.fit(train, categorical), fit_scaler(train, numeric), list(interactions))

    @property
    def n_features(self) -> int:
        return len(self.numeric) + sum(max(0, n - 1) for n in self.levels.sizes.values()) + len(self.interactions)

    @property
    def feature_names(self) -> list[str]:
        return self.numeric + one_hot_names(self.levels.sizes) + [f"{a}_x_{b}" for a, b in self.interactions]

    def _cells(self) -> Column:
        """The design row without its zero one-hot entries, in feature order, as
        an array of ``(feature_index, feature, value)``."""
        def cell(index, name, value):
            return F.struct(index.cast("int").alias("feature_index"), name.alias("feature"), value.cast("double").alias("value"))
        sc, at, cells = scaled_columns(self.scaler), 0, []
        for c in self.numeric:
            cells.append(cell(F.lit(at), F.lit(c), sc[c]))
            at += 1
        for c, n in self.levels.sizes.items():
            o = F.col(f"_ord_{c}")
            cells.append(cell(F.lit(at - 1) + o, F.concat_ws("_", F.lit(c), o.cast("string")), F.when(o > 0, 1.0)))
            at += max(0, n - 1)
        for a, b in self.interactions:
            cells.append(cell(F.lit(at), F.lit(f"{a}_x_{b}"), interaction(a, b)))
            at += 1
        return F.filter(F.array(*cells), lambda x: x["value"] != 0)

    def transform_cells(self, df: DataFrame, keep: Sequence[str] = (), col: str = "x") -> DataFrame:
        """F5 (SQL form): the design row as an array of its non-zero entries."""
        return self.levels.join(df).select(*keep, self._cells().alias(col))

    def transform_sparse(self, df: DataFrame, key: str) -> DataFrame:
        """Non-zero design entries ``(key, feature_index, feature, value)``."""
        return self.transform_cells(df, [key]).select(key, F.explode("x").alias("x")).select(key, "x.feature_index", "x.feature", "x.value")

    def transform_vector(self, df: DataFrame, keep: Sequence[str] = (), col: str = "features") -> DataFrame:
        """F5 (MLlib form): scaled numerics and one sparse one-hot vector per
        column, assembled.  Level k has slot k - 1; the first level and unseen
        ones go to the last slot, which the encoder drops."""
        spark, sc = df.sparkSession, scaled_columns(self.scaler)
        hot = {c: n for c, n in self.levels.sizes.items() if n > 1}
        wide = self.levels.join(df).select(
            *keep, *[sc[c].alias(f"_n_{c}") for c in self.numeric],
            *[F.when(F.col(f"_ord_{c}") > 0, F.col(f"_ord_{c}") - 1).otherwise(n - 1).cast("double").alias(f"_i_{c}") for c, n in hot.items()],
            *[interaction(a, b) for a, b in self.interactions])
        if hot:
            encoder = OneHotEncoder(inputCols=[f"_i_{c}" for c in hot], outputCols=[f"_h_{c}" for c in hot], dropLast=True)
            widths = spark.createDataFrame([tuple(float(n - 1) for n in hot.values())], [f"_i_{c}" for c in hot])
            wide = encoder.fit(widths).transform(wide)
        inputs = [f"_n_{c}" for c in self.numeric] + [f"_h_{c}" for c in hot] + [f"{a}_x_{b}" for a, b in self.interactions]
        return VectorAssembler(inputCols=inputs, outputCol=col).transform(wide).select(*keep, col)


def tree_prep(df: DataFrame, levels: Levels, numeric: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """raw numerics (as double) ++ label-encoded categoricals."""
    return label_encode(df, levels).select(*keep, *[F.col(c).cast("double").alias(c) for c in numeric], *levels.sizes)
