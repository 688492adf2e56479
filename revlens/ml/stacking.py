"""Stacked classifiers: out-of-fold probabilities of the bases feed a meta classifier."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from revlens.ml.classifiers import Classifier
from revlens.ml.vectorize import _param
from revlens.operators.split import folds
from revlens.session import drop_staged, staged


DEFAULTS = {
    "labelCol": "label", "featuresCol": "features", "idCol": "id", "numFolds": 3, "classes": 2,
    "passthrough": True, "parallelism": 2, "seed": 42,
}


def in_parallel(jobs: list[Callable], width: int) -> list:
    """Run Spark jobs from several driver threads; results in the order of the jobs."""
    if width <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPool(min(width, len(jobs))) as pool:
        return pool.map(lambda job: job(), [inherit(job) for job in jobs])


class Stacking(Estimator, HasLabelCol, HasFeaturesCol):
    """Bases are fitted per fold for the meta features, then once on all rows for prediction.

    The input is written once to the shared folder, a partition a fold; a fit that leaves a fold out doesn't open its files.
    """

    numFolds = _param("numFolds", "folds for the meta features", TypeConverters.toInt)
    classes = _param("classes", "number of classes, labelled 0..K-1", TypeConverters.toInt)
    passthrough = _param("passthrough", "meta classifier also sees the features", TypeConverters.toBoolean)
    idCol = _param("idCol", "unique row id", TypeConverters.toString)
    parallelism = _param("parallelism", "fits at a time", TypeConverters.toInt)
    seed = _param("seed", "seed of the folds", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, bases=None, meta=None, numFolds=3, classes=2, passthrough=True, idCol="id",
                 labelCol="label", featuresCol="features", parallelism=2, seed=42):
        super().__init__()
        self._setDefault(**DEFAULTS)
        self.bases: dict[str, Classifier] = bases
        self.meta: Classifier = meta
        self._set(**{k: v for k, v in self._input_kwargs.items() if k not in ("bases", "meta")})

    def copy(self, extra=None):
        that = super().copy(extra)
        that.bases = {n: b.copy(extra) for n, b in self.bases.items()}
        that.meta = self.meta.copy(extra)
        return that

    def steps(self) -> dict:
        """Named parts for `param_map`."""
        return {"stack": self, **self.bases, "final_estimator": self.meta}

    def out_of_fold(self, df: DataFrame) -> DataFrame:
        """id, label, features and the base probabilities of models that did not see the row."""
        return self._out_of_fold(self._prepare(df))

    def _prepare(self, df: DataFrame) -> DataFrame:
        get = self.getOrDefault
        rows = df.select(get("idCol"), self.getLabelCol(), self.getFeaturesCol())
        numbered = folds(rows, get("idCol"), get("numFolds"), self.getLabelCol(), get("seed"), "_fold")
        return staged(numbered, "stack-folds", by="_fold")

    def _out_of_fold(self, rows: DataFrame) -> DataFrame:
        k = self.getOrDefault("numFolds")
        jobs = [
            lambda i=i, b=b: b.fit(rows.where(F.col("_fold") != i))
            for i in range(k)
            for b in self._renamed()
        ]
        models = in_parallel(jobs, self.getOrDefault("parallelism"))
        width = len(self.bases)
        out = None
        for i in range(k):
            part = rows.where(F.col("_fold") == i)
            part = self._meta_columns(part, models[i * width:(i + 1) * width])
            out = part if out is None else out.unionByName(part)
        return out

    def _renamed(self) -> list[Classifier]:
        return [b.renamed(f"_{n}") for n, b in self.bases.items()]

    def _meta_columns(self, df: DataFrame, models: list[Model]) -> DataFrame:
        return meta_columns(df, list(self.bases), models, self.getOrDefault("classes")).select(
            self.getOrDefault("idCol"), self.getLabelCol(), self.getFeaturesCol(), "_base"
        )

    def _fit(self, df: DataFrame) -> StackingModel:
        rows = self._prepare(df)
        # Written too: else every pass of the meta fit would score all rows by all base models again.
        meta_rows = staged(
            with_meta_features(
                self._out_of_fold(rows), self.getFeaturesCol(), self.getOrDefault("passthrough")
            ).select(self.getLabelCol(), "_meta"),
            "stack-meta",
        )
        meta = self.meta.copy()
        meta.inner._set(featuresCol="_meta")
        jobs = [lambda b=b: b.fit(rows) for b in self._renamed()] + [lambda: meta.fit(meta_rows)]
        fitted = in_parallel(jobs, self.getOrDefault("parallelism"))
        drop_staged(rows, meta_rows)
        return self._copyValues(StackingModel(list(self.bases), fitted[:-1], fitted[-1]))


def meta_columns(df: DataFrame, names: list[str], models: list[Model], classes: int) -> DataFrame:
    """Adds `_base`: one probability per base for two classes, else one per base and class.

    The models run one after another on the same row; nothing is joined.
    """
    out = df
    for model in models:
        out = model.transform(out)

    def kept(name: str) -> Column:
        # Padded: a fold may lack the last classes, and its models then give fewer probabilities.
        padded = F.concat(vector_to_array(f"_{name}_probability"), F.array_repeat(F.lit(0.0), classes))
        return F.array(padded[1]) if classes == 2 else F.slice(padded, 1, classes)

    return out.withColumn("_base", array_to_vector(F.concat(*[kept(n) for n in names])))


def with_meta_features(df: DataFrame, features: str, passthrough: bool) -> DataFrame:
    if not passthrough:
        return df.withColumn("_meta", F.col("_base"))
    return VectorAssembler(inputCols=["_base", features], outputCol="_meta").transform(df)


class StackingModel(Model, HasLabelCol, HasFeaturesCol):
    numFolds, classes, passthrough = Stacking.numFolds, Stacking.classes, Stacking.passthrough
    idCol, parallelism, seed = Stacking.idCol, Stacking.parallelism, Stacking.seed

    def __init__(self, names=None, bases=None, meta=None):
        super().__init__()
        self._setDefault(**DEFAULTS)
        self.names, self.bases, self.meta = names, bases, meta

    def _transform(self, df: DataFrame) -> DataFrame:
        out = meta_columns(df, self.names, self.bases, self.getOrDefault("classes"))
        out = with_meta_features(out, self.getFeaturesCol(), self.getOrDefault("passthrough"))
        out = self.meta.transform(out)
        extra = [f"_{n}_{o}" for n in self.names for o in ("prediction", "probability", "rawPrediction")]
        return out.drop("_base", "_meta", *extra)
