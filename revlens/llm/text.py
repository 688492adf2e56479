"""Words, lines and case as the operators of this package understand them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Runs of characters other than the six ASCII spaces."""
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def n_words(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("bigint")


def narrow(df: DataFrame, **named: str) -> DataFrame:
    """Only the named columns, under the operator's own names: whatever else the table holds can't clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in named.items()])


def row_hash(df: DataFrame) -> Column:
    """Equal for rows that are equal in every column; maps, which have no hash, count as their JSON."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        columns.append(F.to_json(F.struct(c.alias("m"))) if "map<" in f.dataType.simpleString() else c)
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """`df`, marked for broadcast if a count finds at most `max_rows` rows; else left to the planner."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, also where `use` has it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def cutoff(keys: DataFrame, n: int, most: int) -> int | None:
    """The `most`-th smallest of `n` 64-bit hashes (key), or the largest one if there are fewer; None if there is none.

    Hashes are even, so those below a bound that follows `n` are few: only these are counted and looked at.
    """
    low, share = -(1 << 63), 2.0
    while n:
        bound = min(low + int((1 << 64) * min(1.0, share * (most + 50) / n)), -low - 1)
        counts = keys.where(F.col("key") <= bound).groupBy("key").count().collect()
        taken = 0
        for r in sorted(counts, key=lambda r: r["key"]):
            taken += r["count"]
            if taken >= most:
                return r["key"]
        if bound == -low - 1:
            return max((r["key"] for r in counts), default=None)
        share *= 8
    return None
