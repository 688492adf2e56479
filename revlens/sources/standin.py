"""The given tables read as review tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from revlens.functions.timefeat import from_unix
from revlens.session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def document_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as reviews: text, source and language as summary, language as category, a derived time."""
    unix = F.lit(1388534400) + F.col("doc_id") * 86399
    day = F.date_format(from_unix(unix), "MM d, yyyy")
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("reviewText"),
        F.concat("source", F.lit(" "), "lang").alias("summary"),
        F.col("lang").alias("category"),
        F.col("source").alias("reviewerID"),
        F.when(F.col("doc_id") % 3 != 0, day).alias("reviewTime"),
        unix.alias("unixReviewTime"),
    )


def labelled_reviews(spark: SparkSession, folder: str, label: str = "quality") -> DataFrame:
    """Documents that carry a label, as a training table."""
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col(label).alias("label"))
    return spread(document_reviews(spark, folder), "id").join(labels, "id")


def event_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Events as ratings 1..5 with reviewer, category and time; no text."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.least(F.lit(5), (1 + F.floor(F.col("value") / 25)).cast("int")).alias("overall"),
        F.col("event_type").alias("category"),
        F.col("user_id").cast("string").alias("reviewerID"),
        F.col("value"),
        F.col("ts"),
    )


def order_times(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as review times: every 7th text is spoiled, every 5th has no epoch seconds."""
    day = F.date_format("o_orderdate", "MM d, yyyy")
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("o_orderdate"))
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("on "), day)).otherwise(day).alias("reviewTime"),
        F.when(F.col("o_orderkey") % 5 != 0, seconds + 3600 * (F.col("o_orderkey") % 24)).alias("unixReviewTime"),
    )


__all__ = [
    "document_reviews", "event_reviews", "labelled_reviews",
    "order_times", "table",
]
