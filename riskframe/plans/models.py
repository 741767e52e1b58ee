"""MLlib model builders and scoring.

Every learner trains distributed on a prepared feature frame that is
materialised once in the shared checkpoint folder (it is read by every fit
of a grid).  The scikit-learn regularisation conventions are mapped onto
MLlib's objective (mean weighted loss + regParam * penalty):

* logistic, C:   ``regParam = 1 / (C * sum(w))``, ``standardization=False``
  (L1: ``elasticNetParam=1``; L2: ``0``); the intercept is not penalised.
* ridge, alpha:  ``regParam = alpha * sd(y) / n`` (sample sd), l-bfgs.
* lasso, alpha:  ``regParam = alpha``, ``elasticNetParam = 1``.
* elastic net, alpha, rho: ``lambda = alpha*rho + alpha*(1-rho)*sd(y)``,
  ``elasticNetParam = alpha*rho / lambda``.

Tree knobs without an MLlib counterpart (``min_samples_split``,
``ccp_alpha``, random splitter) are rejected instead of ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import encode as ENC
from riskframe.operators import metrics as V
from riskframe.session import checkpoint, materialise

UNSUPPORTED_TREE_KNOBS = ("min_samples_split", "ccp_alpha", "splitter")


# ---------------------------------------------------------------- preparation
def linear_frame(split_df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str = "class",
                 key: str = "app_id", weighted: bool = True) -> tuple[DataFrame, ENC.FittedPrep]:
    """F7 + F8 as an MLlib frame: ``key, class, split, features, label,
    y_reg, weight``; preprocessing fitted on the train split only."""
    split_df = materialise(split_df, "split")      # read by the vocabulary, scaler, weight and transform jobs
    train = split_df.where(F.col("split") == "train")
    prep = ENC.FittedPrep.fit(train, numeric, categorical)
    x = prep.transform_vector(split_df, keep=[key, label, "split"], col="features")
    x = x.withColumn("label", (F.col(label) - 1).cast("double")).withColumn("y_reg", F.col(label).cast("double"))
    if weighted:
        w = ENC.class_weights(train, label).select(label, "weight")
        x = x.join(F.broadcast(w), label, "left")          # k class rows
    return materialise(x, "linear-frame"), prep


def tree_frame(split_df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str = "class",
               key: str = "app_id") -> DataFrame:
    """F6 as an MLlib frame (raw numerics ++ label-encoded categoricals)."""
    split_df = materialise(split_df, "split")      # read by the vocabulary, weight and transform jobs
    train = split_df.where(F.col("split") == "train")
    t = ENC.tree_prep(split_df, ENC.Levels.fit(train, categorical), numeric, keep=[key, label, "split"])
    cols = list(numeric) + list(categorical)
    x = VectorAssembler(inputCols=cols, outputCol="features").transform(t).select(key, label, "split", "features")
    x = x.withColumn("label", (F.col(label) - 1).cast("double")).withColumn("y_reg", F.col(label).cast("double"))
    w = ENC.class_weights(train, label).select(label, "weight")
    return checkpoint(x.join(F.broadcast(w), label, "left"))


# ---------------------------------------------------------------- learners
def logistic(train: DataFrame, C: float = 1.0, penalty: str = "l1", balanced: bool = True,
             max_iter: int = 1000, tol: float = 1e-6, total: float | None = None) -> LogisticRegression:
    """M1 / M2 with the scikit-learn C mapped onto regParam.  ``total`` is the
    sum of the weights, if known."""
    if penalty not in ("l1", "l2"):
        raise ValueError(f"penalty must be l1 or l2, not {penalty!r}")
    sw = total or train.agg(F.sum("weight" if balanced else F.lit(1.0))).first()[0]
    lr = LogisticRegression(featuresCol="features", labelCol="label", regParam=1.0 / (C * sw),
                            elasticNetParam=1.0 if penalty == "l1" else 0.0, standardization=False,
                            maxIter=max_iter, tol=tol)
    return lr.setWeightCol("weight") if balanced else lr


def decision_tree(max_depth: int = 5, min_samples_leaf: int = 1, balanced: bool = True,
                  max_features: str | float | None = None, seed: int = 42,
                  max_bins: int = 64, **unsupported) -> object:
    """M3 / M4: a single tree; a per-split feature subset needs the forest
    learner with one tree and no bootstrap."""
    if unsupported:
        known = [k for k in unsupported if k in UNSUPPORTED_TREE_KNOBS]
        raise ValueError(f"no MLlib counterpart for tree parameter(s): {sorted(unsupported)}"
                         + (f" (scikit-learn only: {known})" if known else ""))
    common = dict(featuresCol="features", labelCol="label", maxDepth=max_depth,
                  minInstancesPerNode=min_samples_leaf, impurity="gini", maxBins=max_bins)
    if max_features is None:
        m = DecisionTreeClassifier(seed=seed, **common)
    else:
        m = RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy=str(max_features), seed=seed,
                                   **common)
    return m.setWeightCol("weight") if balanced else m


def tree_regressor(max_depth: int = 5, min_samples_leaf: int = 30, seed: int = 42, max_bins: int = 64) -> DecisionTreeRegressor:
    """M5."""
    return DecisionTreeRegressor(featuresCol="features", labelCol="y_reg", maxDepth=max_depth,
                                 minInstancesPerNode=min_samples_leaf, seed=seed, maxBins=max_bins)


def linear_regression(train: DataFrame, kind: str = "ols", alpha: float = 0.0, l1_ratio: float = 0.5,
                      fit_intercept: bool = True, tol: float = 1e-6, stats: tuple[int, float] | None = None) -> LinearRegression:
    """M6-M9 with the scikit-learn alpha mapped onto regParam.  ``stats`` are
    the rows and the target's sample deviation of ``train``, if known."""
    common = dict(featuresCol="features", labelCol="y_reg", fitIntercept=fit_intercept, standardization=False,
                  maxIter=1000, tol=tol)
    if kind == "ols":
        return LinearRegression(regParam=0.0, **common)
    n, sd = stats or train.agg(F.count(F.lit(1)), F.stddev_samp("y_reg")).first()
    if kind == "ridge":
        if not sd:
            raise ValueError("ridge mapping needs a non-constant target")
        return LinearRegression(regParam=alpha * sd / n, elasticNetParam=0.0, solver="l-bfgs", **common)
    if kind == "lasso":
        return LinearRegression(regParam=alpha, elasticNetParam=1.0, **common)
    if kind == "elasticnet":
        if not sd:
            raise ValueError("elastic-net mapping needs a non-constant target")
        lam = alpha * l1_ratio + alpha * (1 - l1_ratio) * sd
        return LinearRegression(regParam=lam, elasticNetParam=alpha * l1_ratio / lam, **common)
    raise ValueError(f"unknown linear model {kind!r}")


def mlp(n_features: int, hidden: Sequence[int] = (64, 32), max_iter: int = 100, step: float = 0.03,
        block: int = 128, seed: int = 42) -> MultilayerPerceptronClassifier:
    """M10 (re-aimed): sigmoid hidden layers, softmax output, L-BFGS."""
    return MultilayerPerceptronClassifier(featuresCol="features", labelCol="label",
                                          layers=[n_features, *hidden, 2], maxIter=max_iter, stepSize=step,
                                          blockSize=block, seed=seed)


# ---------------------------------------------------------------- scoring
def predict(model, df: DataFrame, keep: Sequence[str] = ("app_id", "class", "split"),
            classifier: bool = True) -> DataFrame:
    """Hard prediction on the 1/2 label scale and P(class 2)."""
    out = model.transform(df)
    if classifier:
        return out.select(*keep, (F.col("prediction") + 1).cast("int").alias("yhat"),
                          F.round(vector_to_array("probability")[1], 9).alias("p"))
    return out.select(*keep, F.col("prediction").alias("reg_pred"))


def predict_each(models: Mapping[int, object], df: DataFrame, name: str, keep: Sequence[str]) -> DataFrame:
    """:func:`predict` of several classifiers, ``(name, keep.., yhat, p)``, from
    one scan: a row per model and row, without the features."""
    out, found = df, []
    for i, model in models.items():
        own = model.copy().setRawPredictionCol(f"_raw{i}").setProbabilityCol(f"_prob{i}").setPredictionCol(f"_label{i}")
        out = own.transform(out)
        found.append(F.struct(F.lit(i).alias(name), (F.col(f"_label{i}") + 1).cast("int").alias("yhat"), F.round(vector_to_array(f"_prob{i}")[1], 9).alias("p")))
    return out.select(*keep, F.inline(F.array(*found))).select(name, *keep, "yhat", "p")


def classification_report(pred: DataFrame, group_cols: Sequence[str] = ("split",)) -> DataFrame:
    g = list(group_cols)
    cls = V.classification_metrics(pred, group_cols=g)
    auc = V.roc_auc(pred, group_cols=g).select(*g, "roc_auc")
    return cls.join(auc, g).select(*g, "n", "accuracy", "precision_pos2", "recall_pos2", "f1_pos2", "f1_weighted",
                                   "roc_auc")


def regression_report(pred: DataFrame, group_cols: Sequence[str] = ("split",)) -> DataFrame:
    return V.regression_metrics(pred, "class", "reg_pred", list(group_cols))


def coefficients(model, names: Sequence[str]) -> DataFrame:
    """Fitted linear coefficients as a table ``(feature, weight)`` with the
    intercept row (feeds M12 / V11)."""
    spark = SparkSession.getActiveSession()
    w = model.coefficients.toArray().tolist()
    rows = [("(intercept)", float(model.intercept))] + [(n, float(x)) for n, x in zip(names, w)]
    return spark.createDataFrame(rows, "feature string, weight double")


def nonzero_count(model, tol: float = 1e-5) -> int:
    """M8: number of coefficients with |w| > tol."""
    return int(sum(1 for x in model.coefficients.toArray() if abs(x) > tol))


def loss_curve(model, run_id: str) -> DataFrame:
    """Objective per iteration ``(run_id, epoch, loss, val_loss)``;
    MLlib records no validation loss, so ``val_loss`` is NULL."""
    spark = SparkSession.getActiveSession()
    summary = model.summary() if callable(model.summary) else model.summary
    hist = list(summary.objectiveHistory)
    return spark.createDataFrame([(run_id, i, float(v), None) for i, v in enumerate(hist)],
                                 "run_id string, epoch int, loss double, val_loss double")


def save_model(model, path: str) -> str:
    """Persist a fitted model as a pipeline under ``path`` (no pickle)."""
    pm = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    pm.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------- grids
def fit_grid(configs: Sequence[Mapping], build: Callable[[Mapping], object], train: DataFrame,
             evaluate: Callable[[object], Mapping], parallelism: int = 4) -> list[dict]:
    """Fit and score every configuration with a driver thread pool
    (the cached training frame is shared); a failing configuration is kept
    as a row with its ``error`` instead of being swallowed."""
    def one(cfg):
        row = dict(cfg)
        try:
            model = build(cfg).fit(train)
            row.update(evaluate(model))
            row["error"] = None
        except Exception as exc:  # noqa: BLE001 - recorded, not swallowed
            row["error"] = f"{type(exc).__name__}: {str(exc).splitlines()[0][:200]}"
        return row
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(one, configs))
