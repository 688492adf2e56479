"""Reproducible row order that does not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KEY_BITS = 60


def order_key(c: Column | str, seed: int | Column = 42) -> Column:
    """Uniform 60-bit key of a row id and a seed."""
    start = F.lit(f"{seed}:") if isinstance(seed, int) else F.concat(seed.cast("string"), F.lit(":"))
    text = F.concat(start, (F.col(c) if isinstance(c, str) else c).cast("string"))
    key = F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("bigint")
    return F.coalesce(key, F.lit(0))  # never NULL, so joins on it need no extra filter
