"""Labels from ratings, class counts and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CUTOFFS = (1, 2, 3, 4)
MAX_CLASSES = 10_000  # what is a class column: one limit for class counts and confusion tables


def label_name(cutoff: int) -> str:
    return f"binary_label_cutoff_{cutoff}"


def above(rating: Column | str, cutoff: int) -> Column:
    """1 above the cutoff, else 0; a missing rating is not above anything."""
    value = F.col(rating) if isinstance(rating, str) else rating
    return F.coalesce((value > cutoff) & ~F.isnan(value.cast("double")), F.lit(False)).cast("int")


def binary_labels(df: DataFrame, rating: str = "overall", cutoffs: tuple[int, ...] = CUTOFFS) -> DataFrame:
    return df.withColumns({label_name(c): above(rating, c) for c in cutoffs})


def class_counts(df: DataFrame, label: str) -> list[tuple]:
    """(class, rows) on the driver, smallest class first; refuses what is not a class column."""
    rows = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values: not a class column")
    return sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0]))


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, class_count, weight) with weight = rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("class_count"))
    total = counts.agg(F.sum("class_count")).scalar()
    classes = counts.agg(F.count("*")).scalar()
    return counts.withColumn("weight", total / (classes * F.col("class_count")))


def weight_expression(counts: list[tuple], label: str) -> Column:
    """The same weights as one CASE expression, so that no row has to move to its class."""
    total = sum(n for _, n in counts)
    expression = F.lit(1.0)
    for value, n in counts:
        expression = F.when(
            F.col(label).eqNullSafe(F.lit(value)), F.lit(total / (len(counts) * n))
        ).otherwise(expression)
    return expression


def add_class_weight(df: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    return df.withColumn(out, weight_expression(class_counts(df, label), label))
