"""Second moments of a design, and linear models judged by them.

One aggregation gives, per split (or fold), the sums ``z_i z_j`` of the row
``z = (y, 1, x_1 .. x_d)``.  They are mergeable: tasks add up their own and
return one small triangle each.  From them follow, for **any** coefficient
vector and without another pass over rows, the squared error, R squared, the
gradient, and how far a penalised objective is above its minimum:

* no L1 part: the objective is quadratic, so the distance is half the Newton
  decrement;
* with one: the duality gap of the scaled residual as dual point.

Only absolute errors need the rows again: one scan serves every model.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Y, ONE = -1, 0              # numbers of the target and of the constant; features count from 1
MAX_FEATURES = 4096         # a triangle of 8 million sums


def _rows(batch: pa.RecordBatch, vec: str, y: str) -> np.ndarray:
    """Rows ``(y, 1, x..)`` of a batch."""
    x = np.asarray(batch.column(vec).flatten(), np.float64).reshape(batch.num_rows, -1)
    target = batch.column(y).to_numpy(zero_copy_only=False).astype(np.float64)
    return np.column_stack([target, np.ones(len(x)), x])


def moments(df: DataFrame, vec: str, y: str, group: str) -> DataFrame:
    """``(group, i, j, value)`` with ``i <= j``: sums over the rows of each
    group; zero sums are left out.  ``vec`` is an array column of one length
    without nulls, ``y`` a number."""
    kind = df.schema[group].dataType

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            z, of = _rows(batch, vec, y), np.array(batch.column(group).to_pylist(), object)
            if z.shape[1] > MAX_FEATURES + 2:
                raise ValueError(f"moments of more than {MAX_FEATURES} features")
            for g in set(of.tolist()):
                own = z[of == g]
                sums[g] = sums.get(g, 0.0) + own.T @ own
        for g, s in sums.items():
            i, j = np.nonzero(np.triu(s))
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(i), batch_type), pa.array((i - 1).astype(np.int32)), pa.array((j - 1).astype(np.int32)), pa.array(s[i, j])], [group, "i", "j", "value"])

    from pyspark.sql.pandas.types import to_arrow_type
    batch_type = to_arrow_type(kind)
    schema = df.select(group).schema.add("i", "integer").add("j", "integer").add("value", "double")
    return df.select(group, vec, y).mapInArrow(add, schema).groupBy(group, "i", "j").agg(F.sum("value").alias("value"))


@dataclass
class Moments:
    """The moments of one group as a symmetric matrix over (y, 1, x..)."""
    z: np.ndarray

    @classmethod
    def collect(cls, table: DataFrame, group: str, n_features: int) -> dict:
        out: dict = {}
        for r in table.collect():  # (d + 2)^2 / 2 sums a group
            z = out.setdefault(r[group], np.zeros((n_features + 2, n_features + 2)))
            z[r["i"] + 1, r["j"] + 1] = z[r["j"] + 1, r["i"] + 1] = r["value"]
        return {g: cls(z) for g, z in out.items()}

    @property
    def n(self) -> float:
        return float(self.z[1, 1])

    def deviation(self) -> float:
        """Population deviation of the target."""
        return max(0.0, float(self.z[0, 0] / self.n - (self.z[0, 1] / self.n) ** 2)) ** 0.5

    def equivalent_rows(self) -> np.ndarray:
        """A few rows ``(y, x..)``, at most ``2 (d + 1)``, whose mean and mean
        products are those of all rows: ``mean +- s_i``, where the ``s_i`` span
        the covariance.  Any penalised least-squares mean loss has the same value
        on them as on all rows, with an intercept and without."""
        at = [0, *range(2, len(self.z))]
        mean = self.z[1, at] / self.n
        square = self.z[np.ix_(at, at)] / self.n
        cov = square - np.outer(mean, mean)
        cov = np.where(np.outer(*2 * [np.diag(cov) > 1e-14 * np.diag(square)]), cov, 0.0)      # constant columns stay constant
        values, vectors = np.linalg.eigh(cov)
        keep = values > 1e-15 * max(0.0, float(values.max(initial=0.0)))
        spread = (vectors[:, keep] * np.sqrt(values[keep] * keep.sum())).T
        return np.concatenate([mean + spread, mean - spread]) if keep.any() else mean[None]

    def errors(self, coef: Sequence[float], intercept: float) -> dict[str, float]:
        """RMSE and R squared of a linear model."""
        v = np.concatenate([[1.0, -intercept], -np.asarray(coef, float)])
        sse = max(0.0, float((self.z * np.outer(v, v)).sum()))
        sst = float(self.z[0, 0] - self.z[0, 1] ** 2 / self.n)
        return {"rmse": (sse / self.n) ** 0.5, "r2": 1.0 - sse / sst if sst > 0 else float("nan")}

    def quadratic(self, fit_intercept: bool) -> tuple[np.ndarray, np.ndarray, float]:
        """``A, b, c`` with mean squared error ``c - 2 b w + w A w`` at the best intercept."""
        z = self.z
        centred = z - np.outer(z[1], z[1]) / self.n if fit_intercept else z
        return centred[2:, 2:] / self.n, centred[2:, 0] / self.n, float(centred[0, 0] / self.n)

    def above_minimum(self, coef: Sequence[float], l1: float, l2: float, fit_intercept: bool = True) -> float:
        """An upper bound (exact without ``l1``) of how far the objective
        ``mse / 2 + l1 |w| + l2 / 2 w^2`` is above its minimum."""
        w = np.asarray(coef, float)
        a, b, c = self.quadratic(fit_intercept)
        correlation = b - (a * w).sum(axis=1) - l2 * w
        if l1 == 0:
            return 0.5 * float((correlation * solve(a + l2 * np.eye(len(w)), correlation)).sum())
        residual = c - 2 * float((b * w).sum()) + float((a * np.outer(w, w)).sum()) + l2 * float((w * w).sum())
        scale = min(1.0, l1 / max(1e-300, float(np.abs(correlation).max(initial=0))))
        return 0.5 * (1 + scale * scale) * residual + l1 * float(np.abs(w).sum()) - scale * (c - float((b * w).sum()))

    def least_squares(self, l2: float = 0.0, fit_intercept: bool = True) -> np.ndarray:
        """The coefficients that minimise the objective without an L1 part."""
        a, b, _ = self.quadratic(fit_intercept)
        return solve(a + l2 * np.eye(len(b)), b)

    def intercept_of(self, coef: Sequence[float]) -> float:
        """The best intercept for given coefficients."""
        return float((self.z[0, 1] - (self.z[1, 2:] * np.asarray(coef, float)).sum()) / self.n)


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A symmetric, positive semidefinite system by elimination with diagonal
    pivots; directions without curvature get 0.  Plain numpy: a few hundred
    features on the driver."""
    a, x = a.copy(), b.astype(float).copy()
    scale = max(1e-300, float(np.abs(np.diag(a)).max(initial=0)))
    left, order = list(range(len(b))), []
    while left:
        p = max(left, key=lambda i: a[i, i])
        if a[p, p] <= 1e-12 * scale:
            break
        left.remove(p)
        order.append(p)
        factor = a[left, p] / a[p, p]
        a[left] -= factor[:, None] * a[p]
        x[left] -= factor * x[p]
    out = np.zeros(len(b))
    for p in reversed(order):
        out[p] = (x[p] - (a[p, order] * out[order]).sum()) / a[p, p]
    return out


def scan_errors(df: DataFrame, vec: str, y: str, group: str, models: Sequence[tuple[Sequence[float], float]]) -> DataFrame:
    """``(group, model, n, mae, rmse)`` of many linear models in one scan of the
    rows; the coefficients are broadcast (models x features numbers)."""
    weights = np.array([[0.0, b, *w] for w, b in models])
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            z, of = _rows(batch, vec, y), np.array(batch.column(group).to_pylist(), object)
            for g in set(of.tolist()):
                own = z[of == g]
                miss = own[:, :1] - own @ shared.value.T
                sums[g] = sums.get(g, 0.0) + np.stack([np.full(miss.shape[1], float(len(own))), np.abs(miss).sum(axis=0), (miss * miss).sum(axis=0)])
        for g, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([g] * s.shape[1], batch_type), pa.array(np.arange(s.shape[1], dtype=np.int32)), *map(pa.array, s)], [group, "model", "n", "a", "s"])

    from pyspark.sql.pandas.types import to_arrow_type
    batch_type = to_arrow_type(df.schema[group].dataType)
    schema = df.select(group).schema.add("model", "integer").add("n", "double").add("a", "double").add("s", "double")
    total = df.select(group, vec, y).mapInArrow(add, schema).groupBy(group, "model").agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("s").alias("s"))
    return total.select(group, "model", F.col("n").cast("long").alias("n"), (F.col("a") / F.col("n")).alias("mae"), F.sqrt(F.col("s") / F.col("n")).alias("rmse"))
