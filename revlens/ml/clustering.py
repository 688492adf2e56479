"""K-means that gives the same clusters wherever it runs, and its quality."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from revlens.functions.ordering import KEY_BITS, order_key
from revlens.session import drop_staged, staged

ROWS = 1024  # of a batch that are dense at a time


def _dense(parts: pd.DataFrame, d: int):
    """Blocks of rows (size, indices, values) as matrices."""
    for at in range(0, len(parts), ROWS):
        block = parts.iloc[at:at + ROWS]
        x = np.zeros((len(block), d))
        for row, (indices, values) in enumerate(zip(block["indices"], block["values"])):
            x[row, slice(None) if indices is None else indices] = values
        yield block, x


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances [row, center], from differences: equal points have none."""
    return np.stack([((x - c) ** 2).sum(1) for c in centers], 1)


def kmeans(df: DataFrame, k: int, features: str = "features", seed: int = 42, max_iter: int = 20, row_id: str = "id",
           tolerance: float = 1e-9) -> KMeansModel:
    """Centers drawn one after another by squared distance, then Lloyd's steps until none moves further than `tolerance`.

    The draw gives each row the key -ln(u) / distance^2, u from the hash of its id and the step, and takes the
    smallest, which is sampling in proportion to the squared distance and the same on any cluster. A draw or a step is one pass
    over the staged rows; a task sends one row or k sums. With fewer than k different rows there are fewer centers.
    """
    x = F.unwrap_udt(features)
    rows = staged(df.select(F.col(row_id).alias("id"), x.alias("x")).select("id", "x.size", "x.indices", "x.values"), "kmeans")
    d = rows.agg(F.max(F.coalesce("size", F.size("values")))).first()[0]
    if d is None:
        raise ValueError("no rows to cluster")
    centers = np.zeros((0, d))
    for step in range(k):
        drawn = _drawn(rows.withColumn("key", order_key("id", seed + step)), centers, d)
        if drawn is None:
            break
        centers = np.vstack([centers, drawn])
    for _ in range(max_iter):
        moved = _moved(rows, centers, d)
        shift = np.abs(moved - centers).max()
        centers = moved
        if shift <= tolerance:
            break
    drop_staged(rows)
    return KMeansModel(centers, features)


def _drawn(rows: DataFrame, centers: np.ndarray, d: int) -> np.ndarray | None:
    def least(batches):
        best = None
        for batch in batches:
            for block, x in _dense(batch, d):
                key = block["key"].to_numpy()
                score = key.astype("f8")
                if len(centers):
                    far = _distances(x, centers).min(1)
                    score = np.full(len(x), np.inf)
                    score[far > 0] = -np.log((key[far > 0] + 0.5) / 2.0 ** KEY_BITS) / far[far > 0]
                at = np.lexsort((key, score))[0]
                if np.isfinite(score[at]) and (best is None or (score[at], key[at]) < best[:2]):
                    best = (score[at], key[at], x[at])
        if best:
            yield pd.DataFrame({"score": [best[0]], "key": [best[1]], "x": [best[2]]})

    found = rows.mapInPandas(least, "score double, key bigint, x array<double>").orderBy("score", "key").first()
    return None if found is None else np.array(found["x"])


def _moved(rows: DataFrame, centers: np.ndarray, d: int) -> np.ndarray:
    """The means of the rows nearest to each center; a center without rows stays."""

    def sums(batches):
        total, count = np.zeros_like(centers), np.zeros(len(centers))
        for batch in batches:
            for _, x in _dense(batch, d):
                nearest = _distances(x, centers).argmin(1)
                np.add.at(total, nearest, x)
                count += np.bincount(nearest, minlength=len(centers))
        yield pd.DataFrame({"cluster": range(len(centers)), "sums": list(np.hstack([total, count[:, None]]))})

    parts = rows.mapInPandas(sums, "cluster int, sums array<double>").withColumn("sums", array_to_vector("sums"))
    out = centers.copy()
    for r in parts.groupBy("cluster").agg(Summarizer.sum(F.col("sums")).alias("s")).collect():
        found = r["s"].toArray()
        if found[-1]:
            out[r["cluster"]] = found[:-1] / found[-1]
    return out


class KMeansModel(Model, HasFeaturesCol, HasPredictionCol):
    """Adds `cluster`, the nearest center, the first of equals."""

    def __init__(self, centers: np.ndarray | None = None, features: str = "features"):
        super().__init__()
        self._setDefault(featuresCol=features, predictionCol="cluster")
        self.centers = centers

    def _transform(self, df: DataFrame) -> DataFrame:
        centers = self.centers

        @F.pandas_udf("int")
        def nearest(parts: pd.DataFrame) -> pd.Series:
            found = [_distances(x, centers).argmin(1) for _, x in _dense(parts, centers.shape[1])]
            return pd.Series(np.concatenate(found) if found else [], dtype="int32")

        return df.withColumn(self.getPredictionCol(), nearest(F.unwrap_udt(self.getFeaturesCol())))


def silhouette(df: DataFrame, features: str = "features", cluster: str = "cluster") -> DataFrame:
    """Mean silhouette under squared Euclidean distance, as a one-row table.

    Distances to a cluster come from its size, sum and norm, so no pairs of rows are formed.
    """
    evaluator = ClusteringEvaluator(featuresCol=features, predictionCol=cluster)
    value = evaluator.evaluate(df.select(features, F.col(cluster).cast("double").alias(cluster)))
    return df.sparkSession.range(1).select(F.lit(value).alias("silhouette"))
