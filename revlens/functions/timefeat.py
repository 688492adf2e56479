"""Review time: parsing, fallbacks, calendar parts and age."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

# The review time format, and the formats tried by the lenient parse.
REVIEW_TIME = "M d, yyyy"
LENIENT_FORMATS = (
    "M d, yyyy",
    "yyyy-M-d",
    "yyyy-M-d H:m:s",
    "yyyy/M/d",
    "M/d/yyyy",
    "MMM d, yyyy",
    "d MMM yyyy",
)


def parse_review_time(c: Column | str, fmt: str = REVIEW_TIME) -> Column:
    """Zone-free timestamp, NULL where the text does not fit the format."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c, F.lit(fmt)).cast("timestamp_ntz")


def parse_lenient(c: Column | str, formats: tuple[str, ...] = LENIENT_FORMATS) -> Column:
    """First format that fits."""
    return F.coalesce(*[parse_review_time(c, f) for f in formats])


def from_unix(c: Column | str) -> Column:
    """Seconds since 1970 as a zone-free timestamp."""
    seconds = F.col(c) if isinstance(c, str) else c
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def days_since(asof: Column, c: Column) -> Column:
    """Whole days from `c` to `asof`, rounded down also for times after `asof`."""
    day = 86_400_000_000
    micros = F.timestamp_diff("MICROSECOND", c, asof)
    return ((micros - F.pmod(micros, F.lit(day))) / F.lit(day)).cast("int")


def review_time_features(
    df: DataFrame,
    missing: int = 0,
    fallback: str = "row",
    asof: dt.datetime | str | None = None,
    formats: tuple[str, ...] = (REVIEW_TIME,),
    time_col: str = "reviewTime",
    unix_col: str = "unixReviewTime",
) -> DataFrame:
    """Adds `review_date` and its calendar parts; `review_days_since` when `asof` is given.

    fallback "row": epoch seconds stand in for each unparsed row. "all": they stand in only when
    no row at all could be parsed; that is one scalar aggregate over the time column.
    """
    if fallback not in ("row", "all", "none"):
        raise ValueError(f"unknown fallback {fallback!r}")
    parsed = parse_lenient(time_col, formats) if time_col in df.columns else F.lit(None).cast("timestamp_ntz")
    when = parsed
    if fallback != "none" and unix_col in df.columns:
        epoch = from_unix(unix_col)
        if fallback == "row" or time_col not in df.columns:
            when = F.coalesce(parsed, epoch)
        else:
            any_parsed = df.agg(F.coalesce(F.bool_or(parsed.isNotNull()), F.lit(False)).alias("any")).scalar()
            when = F.when(any_parsed, parsed).otherwise(epoch)
    out = df.withColumn("review_date", when)
    at = F.col("review_date")

    def part(value: Column) -> Column:
        return F.coalesce(value.cast("int"), F.lit(missing))

    columns = {
        "review_year": part(F.year(at)),
        "review_month": part(F.month(at)),
        "review_day": part(F.dayofmonth(at)),
        "review_dayofweek": part(F.weekday(at)),
        "review_weekday": part(F.weekday(at)),
        "review_hour": part(F.hour(at)),
    }
    if asof is not None:
        stamp = F.lit(str(asof)).cast("timestamp_ntz")
        columns["review_days_since"] = part(days_since(stamp, at))
    return out.withColumns(columns)
