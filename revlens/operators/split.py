"""Hold-out split, folds and class rebalancing, all from one exact row number per class."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from revlens.operators.labels import class_counts
from revlens.operators.ranking import ranked, rounded


def holdout(df: DataFrame, row_id: str, label: str | None = None, share: float = 0.2,
            seed: int = 42, out: str = "is_test") -> DataFrame:
    """Marks `share` of the rows, of each class when `label` is given, rounded per class."""
    groups = (label,) if label else ()
    numbered = ranked(df, row_id, groups, seed, "_r", "_t")
    marked = F.col("_r") <= rounded(F.col("_t") * F.lit(share))
    return numbered.select(*df.columns, marked.cast("int").alias(out))


def folds(df: DataFrame, row_id: str, k: int, label: str | None = None, seed: int = 42,
          out: str = "fold") -> DataFrame:
    """Fold 0..k-1 of each row; within a class the fold sizes differ by one row at most."""
    groups = (label,) if label else ()
    numbered = ranked(df, row_id, groups, seed, "_r")
    return numbered.select(*df.columns, ((F.col("_r") - 1) % k).cast("int").alias(out))


def undersample(df: DataFrame, row_id: str, label: str, seed: int = 42) -> DataFrame:
    """Every class cut to the size of the smallest one."""
    least = df.groupBy(label).count().agg(F.min("count")).scalar()
    return ranked(df, row_id, (label,), seed, "_r").where(F.col("_r") <= least).select(*df.columns)


def oversample(df: DataFrame, row_id: str, label: str, seed: int = 42, copy: str = "copy",
               chunk: int = 10_000) -> DataFrame:
    """Every class raised to the size of the largest one.

    Each row is repeated evenly; the remainder goes to the first rows in the seeded order.
    `copy` numbers the repetitions from 0. Rows that repeat more than `chunk` times are first cut
    into chunks that move to different tasks, so a tiny class is not written out by one task.
    """
    sizes = [n for _, n in class_counts(df, label)]
    most, least = max(sizes), min(sizes)
    numbered = ranked(df, row_id, (label,), seed, "_r", "_t")
    extra = (F.col("_r") <= F.lit(most) % F.col("_t")).cast("bigint")
    numbered = numbered.withColumn("_times", F.floor(F.lit(most) / F.col("_t")) + extra)
    if most <= chunk * least:
        first, last = F.lit(0).cast("bigint"), F.col("_times") - 1
    else:
        chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_times") - 1) / chunk))
        numbered = numbered.withColumn("_chunk", F.explode(chunks)).repartition(row_id, "_chunk")
        first = F.col("_chunk") * chunk
        last = F.least(F.col("_times"), first + chunk) - 1
    return numbered.withColumn(copy, F.explode(F.sequence(first, last))).select(*df.columns, copy)
