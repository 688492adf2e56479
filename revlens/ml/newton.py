"""Binary logistic regression by Newton steps: for a few hundred features, the exact optimum in a handful of passes.

A step is one pass over the staged rows that sums X^T W X and X^T r, whose size depends on the features only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from revlens.ml.vectorize import _param, placed
from revlens.session import constant_array, drop_staged, staged

GROUPS = 64  # partial sums that reach the driver


def margin(vector: Column | str, weights: list[float], bias: float) -> Column:
    """Dot product of a sparse or dense vector column with fixed weights, plus a bias."""
    parts = F.unwrap_udt(vector)
    w = constant_array(weights, "double")
    at = F.coalesce(parts["indices"], F.sequence(F.lit(0), F.size(parts["values"]) - 1))
    products = F.zip_with(at, parts["values"], lambda i, v: v * F.get(w, i))
    return F.aggregate(products, F.lit(float(bias)), lambda s, v: s + v)


class NewtonParams(HasLabelCol, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    regParam = _param("regParam", "strength of the squared penalty, the bias excepted", TypeConverters.toFloat)
    maxIter = _param("maxIter", "most steps", TypeConverters.toInt)
    tol = _param("tol", "largest step at which it ends", TypeConverters.toFloat)
    weightCol = _param("weightCol", "row weight", TypeConverters.toString)

    def _defaults(self) -> None:
        self._setDefault(labelCol="label", featuresCol="features", predictionCol="prediction", probabilityCol="probability",
                         rawPredictionCol="rawPrediction", regParam=0.0, maxIter=30, tol=1e-10, weightCol="")


class NewtonLogistic(Estimator, NewtonParams):
    """Minimises the weighted mean log loss plus regParam / 2 times the squared weights, for labels 0/1.

    A step that doesn't lower the loss is halved. Rows without label take no part; without a penalty, separable rows
    have no optimum and the steps end at `maxIter`.
    """

    @keyword_only
    def __init__(self, *, labelCol="label", featuresCol="features", predictionCol="prediction", probabilityCol="probability",
                 rawPredictionCol="rawPrediction", regParam=0.0, maxIter=30, tol=1e-10):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> NewtonLogisticModel:
        get, label = self.getOrDefault, F.col(self.getLabelCol())
        weight = F.col(get("weightCol")) if get("weightCol") else F.lit(1.0)
        rows = df.where(label.isNotNull()).select(
            label.cast("double").alias("y"), weight.cast("double").alias("w"), F.unwrap_udt(self.getFeaturesCol()).alias("x")
        ).select("y", "w", F.coalesce("x.size", F.size("x.values")).alias("size"), "x.indices", "x.values")
        rows = staged(rows.mapInArrow(_blocks, "size int, y binary, w binary, row binary, at binary, value binary"), "newton")
        d = rows.agg(F.max("size")).first()[0]
        if d is None:
            raise ValueError("no rows to fit")
        penalty = np.r_[np.full(d, get("regParam")), 0.0]
        beta, (loss, slope, curve) = np.zeros(d + 1), _sums(rows, np.zeros(d + 1), penalty)
        for _ in range(get("maxIter")):
            step = np.linalg.lstsq(curve, slope, rcond=None)[0]
            while True:
                trial = _sums(rows, beta - step, penalty)
                if trial[0] <= loss + 1e-12 * abs(loss) or np.abs(step).max() <= get("tol"):
                    break
                step /= 2
            beta, (loss, slope, curve) = beta - step, trial
            if np.abs(step).max() <= get("tol"):
                break
        drop_staged(rows)
        return self._copyValues(NewtonLogisticModel(beta[:-1], float(beta[-1])))


def _blocks(batches):
    """Up to 1024 rows as one: moving each row's arrays to Python in every pass took nearly all of a step's time."""
    for batch in batches:
        for start in range(0, len(batch), 1024):
            part = batch.slice(start, 1024)
            row, at, values = placed(part.column("indices"), part.column("values"))
            y, w = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w"))
            columns = {"y": y, "w": w, "row": row.astype("i4"), "at": at.astype("i4"), "value": values}
            size = pa.array([max(part.column("size").to_pylist())], pa.int32())
            yield pa.RecordBatch.from_pydict({"size": size, **{c: [v.tobytes()] for c, v in columns.items()}})


def _sums(rows: DataFrame, beta: np.ndarray, penalty: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(loss, gradient, Hessian) at `beta`, whose last entry is the bias."""
    d = len(beta) - 1

    def partial(batches):
        total = np.zeros(2 + (d + 1) + (d + 1) ** 2)
        for batch in batches:
            for block in batch.to_pylist():
                y, w, values = (np.frombuffer(block[c]) for c in ("y", "w", "value"))
                x = np.zeros((len(y), d + 1))
                x[:, d] = 1
                x[np.frombuffer(block["row"], "i4"), np.frombuffer(block["at"], "i4")] = values
                z = x @ beta
                p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                loss = w * (np.logaddexp(0, z) - y * z)
                total += np.r_[w.sum(), loss.sum(), x.T @ (w * (p - y)), (x.T @ (x * (w * p * (1 - p))[:, None])).ravel()]
        yield pa.RecordBatch.from_pydict({"sums": [total.tolist()]})

    parts = rows.mapInArrow(partial, "sums array<double>").select(
        array_to_vector("sums").alias("sums"), F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("g"))
    found = sum(r["s"].toArray() for r in parts.groupBy("g").agg(Summarizer.sum(F.col("sums")).alias("s")).collect())
    loss = found[1] / found[0] + (penalty * beta ** 2).sum() / 2
    return loss, found[2:d + 3] / found[0] + penalty * beta, found[d + 3:].reshape(d + 1, d + 1) / found[0] + np.diag(penalty)


class NewtonLogisticModel(Model, NewtonParams):
    def __init__(self, coefficients=None, intercept=0.0):
        super().__init__()
        self._defaults()
        self.coefficients, self.intercept = coefficients, intercept

    def _transform(self, df: DataFrame) -> DataFrame:
        z = margin(self.getFeaturesCol(), self.coefficients.tolist(), self.intercept)
        p = 1 / (1 + F.exp(-F.col("_z")))
        return df.withColumn("_z", z).withColumns({
            self.getRawPredictionCol(): array_to_vector(F.array(-F.col("_z"), F.col("_z"))),
            self.getProbabilityCol(): array_to_vector(F.array(1 - p, p)),
            self.getPredictionCol(): (F.col("_z") > 0).cast("double")}).drop("_z")
