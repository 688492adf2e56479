"""Declared review schema and column-level table shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

REVIEWS = T.StructType(
    [
        T.StructField("overall", T.DoubleType()),
        T.StructField("verified", T.BooleanType()),
        T.StructField("reviewTime", T.StringType()),
        T.StructField("reviewerID", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("style", T.StringType()),
        T.StructField("reviewerName", T.StringType()),
        T.StructField("reviewText", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("unixReviewTime", T.LongType()),
        T.StructField("vote", T.DoubleType()),
        T.StructField("image", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

# The columns that no model reads, and what stands for a missing value.
UNUSED = ("review_date", "reviewTime", "unixReviewTime", "image", "style", "reviewerName", "asin")
DEFAULTS = {"reviewText": "", "summary": "", "category": "unknown", "vote": 0.0, "verified": 0}


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop by name; names the table does not have are ignored."""
    return df.drop(*names)


def keep_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def aligned(train: DataFrame, test: DataFrame, wanted: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """Train keeps the wanted columns it has plus the label; test keeps those of them it has."""
    kept = [c for c in wanted if c in train.columns]
    return train.select(*kept, label), keep_columns(test, kept)


def ensure_columns(df: DataFrame, defaults: dict) -> DataFrame:
    """Add each missing column as a constant."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def require_label(df: DataFrame, label: str) -> DataFrame:
    return df.na.drop(subset=[label])


def number(name: str, to: str):
    """A cast that turns what it cannot read into NULL."""
    return F.col(name).try_cast(to)


def fill_and_default(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Add missing columns, then fill NULL and NaN; `vote` becomes double and `verified` int."""
    defaults = DEFAULTS if defaults is None else defaults
    out = ensure_columns(df, defaults)
    casts = {
        "vote": lambda: number("vote", "double"),
        "verified": lambda: number("verified", "int"),
    }
    out = out.withColumns({c: make() for c, make in casts.items() if c in defaults})
    return out.na.fill(defaults)


def by_type(df: DataFrame, max_levels: int | None = None, ignore: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names.

    All text and boolean columns are categorical, whatever their number of values; name raw texts
    and ids in `ignore`. Only a caller who gives `max_levels` has columns with more distinct
    values left out, by one approximate count.
    """
    fields = [f for f in df.schema.fields if f.name not in ignore]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    other = [f.name for f in fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    if max_levels is None or not other:
        return numeric, other
    levels = df.agg(*[F.approx_count_distinct(c).alias(c) for c in other]).first()
    return numeric, [c for c in other if levels[c] <= max_levels]
