"""Per-key tables mapped back onto every row, whatever the keys' skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HOT_SHARE = 100_000  # a key is hot above 1/100000 of all rows: fewer than 100000 keys can be
SALTS = 1024  # at least
SALT_ROWS = 100_000  # rows of a salt in a table large enough to have more


def skew_join(df: DataFrame, lookup: DataFrame, key: str, rows: str, spread_by: Column, wanted: Column | None = None) -> DataFrame:
    """Left join with a per-key table that knows each key's number of rows in its column `rows`.

    Hot keys come from a broadcast table that cannot exceed `HOT_SHARE` rows. Their rows, and those
    without a key, are spread over join keys whose number follows the rows in the join with the
    other keys, so no task receives one key's rows. The found row is added as the struct `found`. Where `wanted`, a
    condition on the lookup, doesn't hold, a key that is not hot finds nothing and its entry is not moved.
    """
    total = lookup.agg(F.sum(rows)).scalar()
    salts = F.greatest(F.lit(SALTS).cast("bigint"), F.coalesce(F.floor(total / SALT_ROWS), F.lit(0)).cast("bigint"))
    entry = F.struct(*[c for c in lookup.columns if c != key])
    hot = lookup.where(F.col(rows) * HOT_SHARE > total).select(key, entry.alias("_hot"))
    # A constant `_z` would be taken out of the join's keys, and all rows without `_k` then meet in one task.
    own = F.pmod(F.xxhash64(key), F.lit(2))
    cold = lookup.where((F.col(rows) * HOT_SHARE <= total) & (F.lit(True) if wanted is None else wanted)).select(
        F.col(key).alias("_k"), own.alias("_z"), entry.alias("_cold")
    )
    keyed = (
        df.join(F.broadcast(hot), on=key, how="left")
        .withColumn("_k", F.when(F.col("_hot").isNull(), F.col(key)))
        .withColumn("_z", F.when(F.col("_k").isNull(), F.pmod(spread_by, salts)).otherwise(own))
    )
    joined = keyed.join(cold, on=["_k", "_z"], how="left")
    return joined.select(*df.columns, F.coalesce("_hot", "_cold").alias("found"))


def key_frequency(df: DataFrame, key: str = "reviewerID", out: str = "reviewer_freq",
                  row_id: str | None = None) -> DataFrame:
    """Adds the number of rows with the same key; rows without a key get 1.

    Counting combines map-side; the counts come back by `skew_join`.
    """
    if key not in df.columns:
        return df.withColumn(out, F.lit(1).cast("bigint"))
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    spread_by = F.xxhash64(row_id) if row_id else F.xxhash64(*df.columns)
    counted = skew_join(df, counts, key, "_n", spread_by)
    return counted.select(*df.columns, F.coalesce("found._n", F.lit(1)).cast("bigint").alias(out))


def frequency_per_side(train: DataFrame, test: DataFrame, key: str = "reviewerID",
                       out: str = "reviewer_freq") -> tuple[DataFrame, DataFrame]:
    """Each side is counted on its own rows."""
    return key_frequency(train, key, out), key_frequency(test, key, out)
