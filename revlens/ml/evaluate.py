"""Macro-F1 as a Spark evaluator, and permutation importance."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, Window as W, functions as F

from revlens.functions.ordering import KEY_BITS, order_key
from revlens.operators import metrics
from revlens.operators.ranking import BUCKET_BYTES
from revlens.session import drop_staged, pieces, staged


class MacroF1Evaluator(Evaluator):
    """Unweighted mean of the classes' F1."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self.label, self.prediction = labelCol, predictionCol

    def _evaluate(self, df: DataFrame) -> float:
        rows = df.select(F.col(self.label).cast("double").alias("l"), F.col(self.prediction).cast("double").alias("p"))
        return float(metrics.macro_f1(rows, "l", "p").first()[0] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def shuffled(df: DataFrame, row_id: str, column: str, seed: int) -> DataFrame:
    """The table with one column's values moved to other rows.

    The leading bits of a seeded order key cut the rows into even random blocks; inside a block
    every row gets the value of the row before it in the seeded order, the first that of the last.
    One shuffle, no join, and no block grows with the table.
    """
    bits = (pieces(df, BUCKET_BYTES, 1, 1 << 18) - 1).bit_length()
    keyed = df.withColumn("_h", order_key(row_id, seed))
    block = W.partitionBy(F.shiftright("_h", KEY_BITS - bits)).orderBy("_h", row_id)
    whole = block.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    value = F.struct(F.col(column).alias("v"))
    moved = keyed.withColumn("_moved", F.coalesce(F.lag(value).over(block), F.last(value).over(whole)))
    return moved.withColumn(column, F.col("_moved.v")).select(*df.columns)


def shuffled_copies(df: DataFrame, row_id: str, columns: list[str], repeats: int, seed: int = 42) -> DataFrame:
    """Copies of the table side by side, numbered by `copy`: 0 as it is, then for each column `repeats` ones with it shuffled.

    Copy 1 + i * repeats + r is `shuffled` with seed + 31 * i + r. All copies are moved by one shuffle.
    """
    bits = (pieces(df, BUCKET_BYTES, 1, 1 << 18) - 1).bit_length()
    plan = [(0, 0, "")] + [(1 + i * repeats + r, seed + 31 * i + r, c) for i, c in enumerate(columns) for r in range(repeats)]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("copy"), F.lit(s).alias("seed"), F.lit(c).alias("column")) for n, s, c in plan]))
    copies = df.withColumn("_c", each).withColumn("_h", order_key(row_id, F.col("_c.seed")))
    block = W.partitionBy("_c.copy", F.shiftright("_h", KEY_BITS - bits)).orderBy("_h", row_id)
    whole = block.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    values = F.struct(*columns)
    moved = copies.withColumn("_moved", F.coalesce(F.lag(values).over(block), F.last(values).over(whole)))
    return moved.select(F.col("_c.copy").alias("copy"), *[
        F.when(F.col("_c.column") == c, F.col(f"_moved.{c}")).otherwise(F.col(c)).alias(c) if c in columns else c for c in df.columns])


def permutation_importance(model: Transformer, df: DataFrame, row_id: str, columns: list[str],
                           evaluator: Evaluator, repeats: int = 5, seed: int = 42) -> DataFrame:
    """(feature, importance_mean, importance_std): score lost when the column is shuffled.

    All shuffled copies go through the model together. Macro-F1 is counted for all copies at once; another evaluator
    reads the written predictions copy by copy.
    """
    predicted = model.transform(shuffled_copies(df, row_id, columns, repeats, seed))
    if isinstance(evaluator, MacroF1Evaluator):
        per_copy = metrics.per_class(predicted, evaluator.label, evaluator.prediction, by=("copy",))
        scores = per_copy.groupBy("copy").agg(F.avg("f1").alias("score"))
    else:
        written = staged(predicted.drop(*columns), "importance", by="copy")
        found = [(i, float(evaluator.evaluate(written.where(F.col("copy") == i)))) for i in range(1 + repeats * len(columns))]
        scores = df.sparkSession.createDataFrame(found, "copy int, score double")
        drop_staged(written)
    names = F.array(*[F.lit(c) for c in columns])
    # One row a copy; the first is the table as it is.
    base = F.max(F.when(F.col("copy") == 0, F.col("score"))).over(W.partitionBy())
    lost = scores.withColumn("lost", base - F.col("score")).where("copy > 0")
    feature = F.get(names, F.floor((F.col("copy") - 1) / repeats).cast("int")).alias("feature")
    return lost.groupBy(feature).agg(F.avg("lost").alias("importance_mean"), F.stddev_pop("lost").alias("importance_std"))
