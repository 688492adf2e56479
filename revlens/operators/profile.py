"""Table profile: shape, missing values, histograms, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T


def _missing(field: T.StructField) -> Column:
    c = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def table_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, row_count, non_null_count, null_count), one scan for all columns."""
    fields = df.schema.fields
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(_missing(f)).alias(f"_m{i}") for i, f in enumerate(fields)],
    )
    entries = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("_rows").alias("row_count"),
            (F.col("_rows") - F.col(f"_m{i}")).alias("non_null_count"),
            F.col(f"_m{i}").alias("null_count"),
        )
        for i, f in enumerate(fields)
    ]
    return counted.select(F.inline(F.array(*entries)))


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def head(df: DataFrame, row_id: str, n: int = 5) -> DataFrame:
    """First rows by id."""
    return df.orderBy(row_id).limit(n)


def histogram(df: DataFrame, column: str, nulls: bool = True, out: str = "rows") -> DataFrame:
    """Rows per value, most frequent first; NULL left out on request."""
    source = df if nulls else df.where(F.col(column).isNotNull())
    return source.groupBy(column).agg(F.count("*").alias(out)).orderBy(F.desc(out), column)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """(class, rows, share); the window runs over one row per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("class")).agg(F.count("*").alias("rows"))
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(W.partitionBy()))


def label_distributions(df: DataFrame, labels: list[str]) -> DataFrame:
    """Class shares of several label columns in one scan: rows per combination of the labels are
    counted first, and only those few combinations are taken apart by label."""
    combos = df.groupBy(*labels).agg(F.count("*").alias("_n"))
    long = combos.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("class"), F.col("_n")) for c in labels]))
    )
    counts = long.where("class IS NOT NULL").groupBy("label", "class").agg(F.sum("_n").alias("rows"))
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(W.partitionBy("label")))


def compare_distributions(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Class rows and shares of both sides; a class missing on one side has 0 rows there."""
    left = class_distribution(train, label).withColumnsRenamed({"rows": "train_rows", "share": "train_share"})
    right = class_distribution(test, label).withColumnsRenamed({"rows": "test_rows", "share": "test_share"})
    return left.join(right, on="class", how="full").na.fill(0)


def duplicates(df: DataFrame, columns: list[str], row_id: str) -> DataFrame:
    """(digest, copies, first_id) of every value combination that occurs more than once.

    Rows are grouped by a 256-bit digest, so no long text is sorted or shuffled, and counting
    combines map-side, so a text repeated in a third of all rows is no hot group.
    """
    parts = [F.coalesce(F.sha2(F.col(c).cast("string"), 256), F.lit("")) for c in columns]
    digest = parts[0] if len(parts) == 1 else F.sha2(F.concat_ws("/", *parts), 256)
    return (
        df.groupBy(digest.alias("digest"))
        .agg(F.count("*").alias("copies"), F.min(row_id).alias("first_id"))
        .where("copies > 1")
    )
