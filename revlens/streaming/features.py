"""Review features of a stream.

Cleaning, statistics, time parts, sentiment and labels look at one row at a time, so they run
unchanged on unbounded input and keep no state. Reviewer frequency is left out: it counts a
closed table.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from revlens.functions.sentiment import Lexicon, add_sentiment
from revlens.operators.labels import binary_labels
from revlens.operators.preprocess import preprocess
from revlens.schema import fill_and_default
from revlens.session import staging_dir


def stream_features(df: DataFrame, lexicon: Lexicon | None = None) -> DataFrame:
    """Row-wise features of arriving reviews."""
    out = add_sentiment(preprocess(fill_and_default(df)), "reviewText", lexicon)
    return binary_labels(out) if "overall" in out.columns else out


def write_stream(df: DataFrame, path: str, name: str, model: Transformer | None = None,
                 columns: list[str] | None = None) -> StreamingQuery:
    """Append features, or a fitted model's answers, to a Parquet table; progress is kept in the
    shared folder under `name`, each stream's own, so a restarted query goes on where it stopped."""
    out = model.transform(df) if model else df
    out = out.select(*columns) if columns else out
    place = f"{staging_dir(df.sparkSession)}/stream-{name}"
    return (
        out.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", place).trigger(availableNow=True).start()
    )
