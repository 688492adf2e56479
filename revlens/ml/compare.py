"""Several classifiers on the same rows, one metric row each."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, functions as F

from revlens.ml.search import cross_val_predict
from revlens.ml.stacking import in_parallel
from revlens.operators import metrics


def _row(name: str, predicted: DataFrame) -> DataFrame:
    rows = predicted.select(F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"))
    return metrics.scores(rows).select(F.lit(name).alias("classifier"), "macro_f1", "accuracy")


def on_holdout(train: DataFrame, test: DataFrame, models: dict[str, Estimator], parallelism: int = 2) -> DataFrame:
    """(classifier, macro_f1, accuracy) on held-out rows, best first."""
    fitted = in_parallel([lambda m=m: m.fit(train) for m in models.values()], parallelism)
    return _table([_row(n, m.transform(test)) for n, m in zip(models, fitted)])


def on_folds(rows: DataFrame, models: dict[str, Estimator], k: int, fold: str = "fold", parallelism: int = 2) -> DataFrame:
    """(classifier, macro_f1, accuracy) of out-of-fold predictions, best first."""
    return _table([_row(n, cross_val_predict(m, rows, k, fold, parallelism)) for n, m in models.items()])


def _table(rows: list[DataFrame]) -> DataFrame:
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.orderBy(F.desc("macro_f1"), "classifier")
