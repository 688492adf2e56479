"""The classifiers of the workload on `pyspark.ml`, with class weights and C-style regularisation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from revlens.functions.ordering import KEY_BITS, order_key
from revlens.ml.boosting import SoftmaxBoosting
from revlens.ml.newton import NewtonLogistic, margin
from revlens.ml.vectorize import UNLIMITED_DEPTH as MAX_DEPTH, _param
from revlens.operators.labels import class_counts, weight_expression
from revlens.session import drop_staged, pieces, staged

BUCKET_BYTES = 32 << 20
TREE_BYTES = 64 << 20  # of binned features in a partition
TREES = (RandomForestClassifier, GBTClassifier)
GROUPS = 64  # partial sums that reach the driver


class Classifier(Estimator, HasLabelCol):
    """Fits the estimator `inner` with what depends on the training rows.

    `balanced` weighs each row by rows / (classes * rows of its class). `C` is the inverse
    regularisation strength over the summed loss: regParam = 1 / (C * rows). `validationShare`
    sets aside rows by a seeded order of `idCol` for early stopping of boosting.
    """

    balanced = _param("balanced", "weigh classes equally", TypeConverters.toBoolean)
    C = _param("C", "inverse regularisation strength; 0 leaves regParam alone", TypeConverters.toFloat)
    validationShare = _param("validationShare", "share of rows for early stopping", TypeConverters.toFloat)
    idCol = _param("idCol", "row id, for the validation rows", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inner=None, labelCol="label", balanced=True, C=0.0, validationShare=0.0, idCol="id"):
        super().__init__()
        self._setDefault(labelCol="label", balanced=True, C=0.0, validationShare=0.0, idCol="id")
        self.inner = inner
        self._set(**{k: v for k, v in self._input_kwargs.items() if k != "inner"})

    def copy(self, extra=None):
        that = super().copy(extra)
        that.inner = self.inner.copy(extra)
        return that

    def renamed(self, prefix: str) -> Classifier:
        """A copy whose output columns start with `prefix`."""
        that = self.copy()
        outputs = {}
        for name in ("predictionCol", "probabilityCol", "rawPredictionCol"):
            if that.inner.hasParam(name):
                outputs[name] = f"{prefix}_{name[:-3]}"
        that.inner._set(**outputs)
        return that

    def _fit(self, df: DataFrame):
        label = self.getLabelCol()
        inner = self.inner.copy()
        inner._set(labelCol=label)
        work = df
        if self.getOrDefault("balanced") or self.getOrDefault("C"):
            counts = class_counts(df.where(F.col(label).isNotNull()), label)
            if self.getOrDefault("balanced"):
                work = work.withColumn("_weight", weight_expression(counts, label))
                inner._set(weightCol="_weight")
            if self.getOrDefault("C"):
                inner._set(regParam=1.0 / (self.getOrDefault("C") * sum(n for _, n in counts)))
        share = self.getOrDefault("validationShare")
        if share:
            held = order_key(self.getOrDefault("idCol"), 7) < F.lit(int(share * 2**KEY_BITS))
            work = work.withColumn("_held_out", held)
            inner._set(validationIndicatorCol="_held_out")
        return inner.fit(tree_pieces(work, inner.getFeaturesCol(), self.getOrDefault("idCol")) if isinstance(inner, TREES) else work)


def tree_pieces(df: DataFrame, features: str, row_id: str, piece_bytes: int = TREE_BYTES) -> DataFrame:
    """The rows in partitions of about `piece_bytes` as trees keep them: four bytes a feature, present in the vector or not.

    Those bytes and not the sparse input's are what a task reads in every pass. Rows that make one piece stay as they are.
    """
    parts = F.unwrap_udt(features)
    rows, width = df.agg(F.count("*"), F.max(F.coalesce(parts["size"], F.size(parts["values"])))).first()
    count = -(-4 * rows * (width or 0) // piece_bytes)
    if count <= 1:
        return df
    count = max(count, df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(count, row_id) if row_id in df.columns else df.repartition(count)


def logistic(C: float = 1.0, penalty: str = "l2", balanced: bool = True, max_iter: int = 100,
             multinomial: bool = False, solver: str = "lbfgs", **columns) -> Classifier:
    """`solver="newton"`: exact steps for two classes, the l2 penalty and a few hundred features."""
    if solver == "newton":
        if multinomial or penalty != "l2":
            raise ValueError("newton is for two classes and the l2 penalty")
        return Classifier(inner=NewtonLogistic(maxIter=max_iter, **columns), balanced=balanced, C=C)
    inner = LogisticRegression(
        elasticNetParam={"l2": 0.0, "l1": 1.0}[penalty], maxIter=max_iter, standardization=False,
        family="multinomial" if multinomial else "auto", **columns,
    )
    return Classifier(inner=inner, balanced=balanced, C=C)


def random_forest(n_estimators: int = 100, max_depth: int | None = None, min_samples_leaf: int = 1,
                  feature_subset: str = "sqrt", balanced: bool = True, seed: int = 42, **columns) -> Classifier:
    """Class weights are those of the whole training set, not of each tree's sample."""
    inner = RandomForestClassifier(
        numTrees=n_estimators, maxDepth=max_depth or MAX_DEPTH, minInstancesPerNode=min_samples_leaf,
        featureSubsetStrategy=str(feature_subset), seed=seed, **columns,
    )
    return Classifier(inner=inner, balanced=balanced)


def gradient_boosting(n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 3,
                      subsample: float = 1.0, feature_subset: str = "all", validation_share: float = 0.0,
                      tolerance: float = 1e-4, classes: int = 2, seed: int = 42, row_id: str = "id",
                      **columns) -> Classifier:
    """Binary boosting is Spark's own; with more classes each round fits a tree a class to the softmax residuals."""
    settings = dict(
        maxIter=n_estimators, stepSize=learning_rate, maxDepth=max_depth, subsamplingRate=subsample,
        featureSubsetStrategy=str(feature_subset), validationTol=tolerance, seed=seed, **columns,
    )
    inner = GBTClassifier(**settings) if classes == 2 else SoftmaxBoosting(classes=classes, **settings)
    return Classifier(inner=inner, balanced=False, validationShare=validation_share, idCol=row_id)


def linear_svm(C: float = 1.0, balanced: bool = True, max_iter: int = 100, **columns) -> Classifier:
    """No probabilities; rows are ranked by the raw margin."""
    return Classifier(inner=LinearSVC(maxIter=max_iter, standardization=False, **columns), balanced=balanced, C=C)


class Perceptron(Estimator, HasLabelCol, HasFeaturesCol, HasPredictionCol):
    """Online perceptron for labels 0/1 by iterative parameter mixing.

    Rows are dealt to buckets by a hash of their id. In every epoch each bucket starts from the mixed weights, goes through
    its rows one by one in a new seeded order and adds each row that lies on the wrong side, times its weight; the buckets'
    results are averaged by their rows. It stops when an epoch has no mistake. A task holds one bucket, and the driver gets
    `GROUPS` partial averages. One bucket is the plain perceptron.
    """

    maxIter = _param("maxIter", "epochs", TypeConverters.toInt)
    weightCol = _param("weightCol", "row weight", TypeConverters.toString)
    buckets = _param("buckets", "buckets that learn side by side; 0: by the size of the rows", TypeConverters.toInt)
    idCol = _param("idCol", "row id, for the buckets and the order", TypeConverters.toString)
    seed = _param("seed", "of the order", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, labelCol="label", featuresCol="features", predictionCol="prediction", maxIter=20, buckets=0, idCol="id", seed=42):
        super().__init__()
        self._setDefault(labelCol="label", featuresCol="features", predictionCol="prediction", maxIter=20, weightCol="",
                         buckets=0, idCol="id", seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PerceptronModel:
        get, label = self.getOrDefault, F.col(self.getLabelCol())
        weight = F.col(get("weightCol")) if get("weightCol") else F.lit(1.0)
        rows = staged(df.where(label.isNotNull()).select(
            F.col(get("idCol")).alias("id"), F.when(label > 0, 1.0).otherwise(-1.0).alias("y"), weight.cast("double").alias("w"),
            F.unwrap_udt(self.getFeaturesCol()).alias("x")).select("id", "y", "w", "x.size", "x.indices", "x.values"), "perceptron")
        n, d = rows.agg(F.count("*"), F.max(F.coalesce("size", F.size("values")))).first()
        if not n:
            raise ValueError("no rows to fit")
        buckets = get("buckets") or pieces(rows, BUCKET_BYTES, 1, 1 << 16)
        dealt = rows.withColumn("bucket", F.pmod(order_key("id", self.seed_of(0)), F.lit(buckets)))
        w = np.zeros(d + 1)
        for epoch in range(1, get("maxIter") + 1):
            w, mistakes = _mixed(dealt.withColumn("order", order_key("id", self.seed_of(epoch))), w, n)
            if not mistakes:
                break
        drop_staged(rows)
        return self._copyValues(PerceptronModel(w[:-1].tolist(), float(w[-1])))

    def seed_of(self, epoch: int) -> int:
        return self.getOrDefault("seed") + epoch


def _mixed(rows: DataFrame, start: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """The average of what the buckets learn in one epoch, and the number of their mistakes."""

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part, w, mistakes = part.sort_values("order"), start.copy(), 0
        for y, weight, at, values in zip(part["y"], part["w"], part["indices"], part["values"]):
            at = slice(0, -1) if at is None else at
            if y * (w[at] @ values + w[-1]) <= 0:
                mistakes += 1
                w[at] += weight * y * values
                w[-1] += weight * y
        return pd.DataFrame({"sums": [np.r_[w * (len(part) / n), mistakes]], "g": [part["bucket"].iloc[0] % GROUPS]})

    parts = rows.groupBy("bucket").applyInPandas(learn, "sums array<double>, g bigint").withColumn("sums", array_to_vector("sums"))
    found = sum(r["s"].toArray() for r in parts.groupBy("g").agg(Summarizer.sum(F.col("sums")).alias("s")).collect())
    return found[:-1], int(found[-1])


class PerceptronModel(Model, HasLabelCol, HasFeaturesCol, HasPredictionCol):
    maxIter, weightCol, buckets, idCol, seed = Perceptron.maxIter, Perceptron.weightCol, Perceptron.buckets, Perceptron.idCol, Perceptron.seed

    def __init__(self, weights=None, bias=0.0):
        super().__init__()
        self._setDefault(labelCol="label", featuresCol="features", predictionCol="prediction")
        self.weights, self.bias = weights, bias

    def _transform(self, df: DataFrame) -> DataFrame:
        positive = margin(self.getFeaturesCol(), self.weights, self.bias) > 0
        return df.withColumn(self.getPredictionCol(), positive.cast("double"))


def perceptron(balanced: bool = True, max_iter: int = 20, **columns) -> Classifier:
    return Classifier(inner=Perceptron(maxIter=max_iter, **columns), balanced=balanced)


def constant(df: DataFrame, value: float = 0.0, out: str = "prediction") -> DataFrame:
    """The baseline that answers the same for every row."""
    return df.withColumn(out, F.lit(float(value)))


def named(name: str, **settings) -> Classifier:
    """A classifier by its short name."""
    known = {
        "logreg": logistic, "rf": random_forest, "gb": gradient_boosting, "svm": linear_svm, "perceptron": perceptron,
    }
    if name not in known:
        raise ValueError(f"unknown classifier {name!r}; known are {sorted(known)}")
    return known[name](**settings)
