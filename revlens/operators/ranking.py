"""Exact row numbers over data of any size and any skew of the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from revlens.functions.ordering import KEY_BITS, order_key
from revlens.session import lookup_join, pieces, staged

BUCKET_BYTES = 32 << 20


def ranked(df: DataFrame, row_id: str, groups: tuple[str, ...] = (), seed: int = 42,
           rank: str = "rank", total: str | None = None, bits: int | None = None) -> DataFrame:
    """1-based number of each row in its group, in a seeded order of the unique `row_id`.

    The order key is uniform, so its leading bits cut every group, however large, into even
    buckets. A row's number is its place inside the bucket plus the rows of the earlier buckets,
    which come from one small count table. The number of buckets follows the size of the table
    and has no influence on the result. Rows without a group value form a group.
    """
    if bits is None:
        bits = (pieces(df, BUCKET_BYTES, 16, 1 << 18) - 1).bit_length()
    group = F.struct(*[F.col(g) for g in groups]) if groups else F.struct(F.lit(0).alias("all"))
    keyed = df.withColumns({"_g": group, "_h": order_key(row_id, seed)}).withColumn(
        "_b", F.shiftright("_h", KEY_BITS - bits).cast("int")
    )
    sizes = keyed.groupBy("_g", "_b").agg(F.count("*").alias("_n"))
    # At most 2**bits rows per group in these windows.
    in_order = W.partitionBy("_g").orderBy("_b")
    offsets = sizes.select(
        "_g",
        "_b",
        (F.sum("_n").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_n")).alias("_before"),
        F.sum("_n").over(W.partitionBy("_g")).alias("_total"),
    )
    place = F.row_number().over(W.partitionBy("_g", "_b").orderBy("_h", row_id))
    extra = [F.col("_total").alias(total)] if total else []
    return keyed.join(offsets, on=["_g", "_b"]).select(
        *df.columns, (F.col("_before") + place).cast("bigint").alias(rank), *extra
    )


def numbered(df: DataFrame, *order: str, out: str = "number") -> DataFrame:
    """Numbers the rows 0, 1, ... in the order of columns: range partitions are sorted, each adds the rows before it.

    The rows are written once, so numbers and rows belong together whatever is read again. `order` should
    tell rows apart; equal ones are numbered in any order.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    rows = staged(rows.withColumn("_part", F.shiftright("_row", 33)), "in-order", keep_shuffles=False)
    parts = rows.groupBy("_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row a partition
    parts = parts.select("_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return lookup_join(rows, parts, ["_part"], "inner").select(*df.columns, (F.col("_row") + F.col("_shift")).alias(out))


def rounded(value: Column) -> Column:
    """Half-up rounding of a positive number to a whole one."""
    return F.floor(value + F.lit(0.5))
