"""Gradient boosting for several classes: each round fits one regression tree a class to the softmax residuals.

Leaf values are Newton steps, (K-1)/K * sum(r) / sum(|r| (1 - |r|)), from one aggregate over all trees of a round.
All trees of a round share one staged table of features, scores and residuals; the next round's table is written from it, so that neither
lineage nor plans grow with the number of rounds, and a lost executor costs one round at most. The residuals are taken once a round, when
that table is written, and Spark's own tree models find the leaves: no row goes to Python during a fit.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from revlens.ml.vectorize import _param, placed
from revlens.session import drop_staged, staged

LEAST = 1e-15  # of a probability in the loss


@dataclass
class Tree:
    """A regression tree as arrays: nodes in depth-first order, `feature` -1 and a leaf number at leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray
    values: np.ndarray | None = None

    @staticmethod
    def of(text: str) -> Tree:
        """From the indented description of a fitted tree."""
        rows, parents, leaves = [], [], 0
        for line in text.splitlines()[1:]:
            depth = len(line) - len(line.lstrip())
            body = line.strip()
            if body.startswith("Else"):
                while parents[-1][0] != depth:
                    parents.pop()
                parents[-1][2] = "right"
                continue
            if not body.startswith(("If", "Predict")):
                continue
            at = len(rows)
            if parents:
                rows[parents[-1][1]][parents[-1][2]] = at
            if body.startswith("Predict"):
                rows.append({"feature": -1, "threshold": 0.0, "left": at, "right": at, "leaf": leaves})
                leaves += 1
            else:
                found = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", body)
                rows.append({"feature": int(found[1]), "threshold": float(found[2]), "left": -1, "right": -1, "leaf": -1})
                parents.append([depth, at, "left"])
        return Tree(*[np.array([r[k] for r in rows], kind) for k, kind in
                      (("feature", "i4"), ("threshold", "f8"), ("left", "i4"), ("right", "i4"), ("leaf", "i4"))])

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def leaf_of(self, x: np.ndarray, column: dict[int, int]) -> np.ndarray:
        """Leaf of each row; `column` says where a feature stands in `x`."""
        place = np.array([column.get(f, 0) for f in self.feature])
        node = np.zeros(len(x), "i4")
        while (inner := self.feature[node] >= 0).any():
            low = x[np.arange(len(x)), place[node]] <= self.threshold[node]
            node = np.where(inner, np.where(low, self.left[node], self.right[node]), node)
        return self.leaf[node]


def used_features(trees: list[Tree]) -> dict[int, int]:
    return {f: i for i, f in enumerate(sorted({int(f) for t in trees for f in t.feature if f >= 0}))}


def dense(parts: pd.DataFrame | pa.StructArray, column: dict[int, int]) -> np.ndarray:
    """The used features of vectors given as (size, indices, values), all rows' entries at once."""
    if isinstance(parts, pd.DataFrame):
        indices, values = pa.array(parts["indices"], pa.list_(pa.int32())), pa.array(parts["values"], pa.list_(pa.float64()))
    else:
        fields = dict(zip([f.name for f in parts.type], parts.flatten()))
        indices, values = fields["indices"], fields["values"]
    x = np.zeros((len(values), max(1, len(column))))
    rows, at, entries = placed(indices, values)
    slot = np.full(max(column, default=0) + 2, -1)
    slot[list(column)] = list(column.values())
    place = slot[np.minimum(at, len(slot) - 1)]
    x[rows[place >= 0], place[place >= 0]] = entries[place >= 0]
    return x


def lists(table: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A row of the table as one list each."""
    n, width = table.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype="i4")), pa.array(table.ravel(), kind))


def leaves(features: str, trees: list[Tree]) -> Column:
    """Leaf number in each tree: the one that Spark's model of the tree gives in its `leafCol`."""
    column = used_features(trees)

    @F.arrow_udf("array<int>")
    def find(parts: pa.Array) -> pa.Array:
        x = dense(parts, column)
        return lists(np.stack([t.leaf_of(x, column) for t in trees], 1), pa.int32())

    return find(F.unwrap_udt(features))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once a row; a column inside a lambda would be computed again for every entry."""
    return F.transform(F.array(value), use)[0]


def softmax(scores: Column) -> Column:
    powers = bound(F.array_max(scores), lambda top: F.transform(scores, lambda s: F.exp(s - top)))
    return bound(powers, lambda each: bound(F.aggregate(each, F.lit(0.0), lambda a, v: a + v), lambda total: F.transform(each, lambda e: e / total)))


class BoostingParams(HasLabelCol, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasSeed):
    classes = _param("classes", "number of classes", TypeConverters.toInt)
    maxIter = _param("maxIter", "rounds", TypeConverters.toInt)
    stepSize = _param("stepSize", "learning rate", TypeConverters.toFloat)
    maxDepth = _param("maxDepth", "depth of a tree", TypeConverters.toInt)
    minInstancesPerNode = _param("minInstancesPerNode", "least rows of a leaf", TypeConverters.toInt)
    subsamplingRate = _param("subsamplingRate", "share of the rows in a round", TypeConverters.toFloat)
    featureSubsetStrategy = _param("featureSubsetStrategy", "features tried at a split", TypeConverters.toString)
    validationIndicatorCol = _param("validationIndicatorCol", "rows for early stopping", TypeConverters.toString)
    validationTol = _param("validationTol", "least fall of the held-out loss", TypeConverters.toFloat)
    patience = _param("patience", "rounds without such a fall before it stops", TypeConverters.toInt)
    parallelism = _param("parallelism", "trees of a round fitted at a time", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(labelCol="label", featuresCol="features", predictionCol="prediction", probabilityCol="probability",
                         classes=2, maxIter=100, stepSize=0.1, maxDepth=3, minInstancesPerNode=1, subsamplingRate=1.0,
                         featureSubsetStrategy="all", validationIndicatorCol="", validationTol=1e-4, patience=20, parallelism=4, seed=42)


class SoftmaxBoosting(Estimator, BoostingParams):
    """Boosting for classes 0..K-1 on the multinomial log loss."""

    @keyword_only
    def __init__(self, *, labelCol="label", featuresCol="features", predictionCol="prediction", probabilityCol="probability",
                 classes=2, maxIter=100, stepSize=0.1, maxDepth=3, minInstancesPerNode=1, subsamplingRate=1.0,
                 featureSubsetStrategy="all", validationTol=1e-4, patience=20, parallelism=4, seed=42):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> SoftmaxBoostingModel:
        get = self.getOrDefault
        k, label, held = get("classes"), F.col(self.getLabelCol()), get("validationIndicatorCol")
        rows = df.where(label.isNotNull()).select(
            label.cast("int").alias("y"), F.col(self.getFeaturesCol()).alias("x", metadata={}),
            (F.col(held) if held else F.lit(False)).alias("held"), F.monotonically_increasing_id().alias("row"))
        counts = {r["y"]: r["count"] for r in rows.where("not held").groupBy("y").count().collect()}
        total = sum(counts.values())
        if not total:
            raise ValueError("no rows to fit")
        start = [math.log(counts[c] / total) if counts.get(c) else -math.inf for c in range(k)]  # a class without rows keeps probability 0
        state = self._state(rows.withColumn("scores", F.array(*map(F.lit, start))))
        rounds, history = [], [self._losses(state)]
        for t in range(get("maxIter")):
            models, trees = self._round(state, t, [c for c in range(k) if counts.get(c)])
            rounds.append(trees)
            moved_on = self._state(moved(with_leaves(state, models), trees, get("stepSize")).select(*rows.columns, "scores"))
            drop_staged(state)
            state = moved_on
            history.append(self._losses(state))
            held_losses = [h for _, h in history if h is not None]
            last = held_losses[-1 - get("patience"):-1]
            if len(last) == get("patience") and all(held_losses[-1] + get("validationTol") >= h for h in last):
                break
        drop_staged(state)
        return self._copyValues(SoftmaxBoostingModel(rounds, start, history))

    def _state(self, rows: DataFrame) -> DataFrame:
        """The rows with scores, written with their residuals `r0`, `r1` ... and their loss, so that no tree takes a softmax again."""
        p = rows.withColumn("p", softmax(F.col("scores")))
        residuals = [((F.col("y") == c).cast("double") - F.col("p")[c]).alias(f"r{c}") for c in range(self.getOrDefault("classes"))]
        loss = -F.log(F.greatest(F.get("p", F.col("y")), F.lit(LEAST)))
        return staged(p.select(*rows.columns, *residuals, loss.alias("loss")), "boosting")

    def _bag(self, t: int) -> Column:
        """The rows of a round, the same ones for all its trees."""
        share = self.getOrDefault("subsamplingRate")
        drawn = F.pmod(F.xxhash64(F.col("row"), F.lit(t), F.lit(self.getSeed())), F.lit(1 << 20)) < int(share * (1 << 20))
        return ~F.col("held") & (drawn if share < 1 else F.lit(True))

    def _round(self, state: DataFrame, t: int, present: list[int]) -> tuple[list[RandomForestRegressionModel | None], list[Tree]]:
        """Spark's models of a round's trees, and the trees with their leaf values; a class without rows has a bare leaf and no model."""
        get, k = self.getOrDefault, self.getOrDefault("classes")
        bag = state.where(self._bag(t))

        def fitted(c: int) -> RandomForestRegressionModel | None:
            if c not in present:
                return None
            return RandomForestRegressor(
                labelCol=f"r{c}", featuresCol="x", predictionCol="", leafCol=f"_leaf{c}", numTrees=1, bootstrap=False,
                maxDepth=get("maxDepth"), seed=self.getSeed() + t, minInstancesPerNode=get("minInstancesPerNode"),
                featureSubsetStrategy=get("featureSubsetStrategy")).fit(bag.select("x", f"r{c}"))

        with ThreadPool(min(k, get("parallelism"))) as pool:
            models = pool.map(inheritable_thread_target(state.sparkSession)(fitted), range(k))
        trees = [Tree.of(m.trees[0].toDebugString if m else "\n  Predict: 0.0") for m in models]
        per_leaf = F.explode(F.array(*[
            F.struct(F.lit(c).alias("tree"), F.col("leaf")[c].alias("leaf"), r.alias("r"), (F.abs(r) * (1 - F.abs(r))).alias("h"))
            for c, r in enumerate(F.col(f"r{c}") for c in range(k))]))
        sums = with_leaves(bag, models).select(per_leaf.alias("s")).select("s.*")
        for tree in trees:
            tree.values = np.zeros(tree.leaves)
        for r in sums.groupBy("tree", "leaf").agg(F.sum("r").alias("r"), F.sum("h").alias("h")).collect():
            trees[r["tree"]].values[r["leaf"]] = (k - 1) / k * r["r"] / r["h"] if r["h"] > 1e-150 else 0.0
        return models, trees

    @staticmethod
    def _losses(state: DataFrame) -> tuple[float | None, float | None]:
        by = {r["held"]: r["loss"] for r in state.groupBy("held").agg(F.avg("loss").alias("loss")).collect()}
        return by.get(False), by.get(True)


def with_leaves(df: DataFrame, models: list[RandomForestRegressionModel | None]) -> DataFrame:
    """Adds `leaf`: the row's leaf number in each tree, found by Spark's models; 0 where there is none."""
    for model in models:
        df = model.transform(df) if model else df
    return df.withColumn("leaf", F.array(*[
        F.unwrap_udt(f"_leaf{c}")["values"][0].cast("int") if m else F.lit(0) for c, m in enumerate(models)]))


def moved(df: DataFrame, trees: list[Tree], rate: float) -> DataFrame:
    """The scores after one more round, from the rows' leaves."""
    values = F.array(*[F.array(*[F.lit(float(rate * v)) for v in t.values]) for t in trees])
    steps = F.zip_with("leaf", values, lambda leaf, v: F.get(v, leaf))
    return df.withColumn("scores", F.zip_with("scores", steps, lambda s, v: s + v))


class SoftmaxBoostingModel(Model, BoostingParams):
    """`rounds` of one tree a class; `history` holds (training, held-out) log loss before the first round and after each."""

    def __init__(self, rounds=None, start=None, history=None):
        super().__init__()
        self._defaults()
        self.rounds, self.start, self.history = rounds, start, history

    def _transform(self, df: DataFrame) -> DataFrame:
        rounds, start, rate = self.rounds, np.array(self.start), self.getOrDefault("stepSize")
        column = used_features([t for trees in rounds for t in trees])

        @F.arrow_udf("array<double>")
        def probability(parts: pa.Array) -> pa.Array:
            x = dense(parts, column)
            scores = np.tile(start, (len(x), 1))
            for trees in rounds:
                for c, tree in enumerate(trees):
                    scores[:, c] += rate * tree.values[tree.leaf_of(x, column)]
            powers = np.exp(scores - scores.max(1, keepdims=True))
            return lists(powers / powers.sum(1, keepdims=True), pa.float64())

        out = df.withColumn("_p", probability(F.unwrap_udt(self.getFeaturesCol())))
        best = (F.array_position("_p", F.array_max("_p")) - 1).cast("double")
        return out.withColumns({self.getProbabilityCol(): array_to_vector("_p"), self.getPredictionCol(): best}).drop("_p")
