"""The feature table of a review set, composed of the row-wise parts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from revlens.functions.sentiment import Lexicon, add_sentiment
from revlens.functions.text import clean_columns, combined_text, text_stats
from revlens.functions.timefeat import review_time_features
from revlens.operators.frequency import key_frequency
from revlens.operators.labels import binary_labels
from revlens.schema import fill_and_default


def preprocess(df: DataFrame, with_time: bool = True) -> DataFrame:
    """Clean both texts, add time features, then statistics of the cleaned text."""
    out = clean_columns(df, "reviewText", "summary")
    if with_time and ("reviewTime" in df.columns or "unixReviewTime" in df.columns):
        out = review_time_features(out)
    return text_stats(out)


def review_features(df: DataFrame, row_id: str = "id", combined: bool = False,
                    lexicon: Lexicon | None = None, with_time: bool = True) -> DataFrame:
    """The whole feature table: everything row-wise in one projection, then one counting join."""
    out = preprocess(fill_and_default(df), with_time)
    if combined:
        out = out.withColumn("combined_text", combined_text("reviewText", "summary"))
    out = add_sentiment(out, "combined_text" if combined else "reviewText", lexicon)
    if "overall" in out.columns:
        out = binary_labels(out)
    return key_frequency(out, "reviewerID", row_id=row_id)


