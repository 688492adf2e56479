"""Connected components of an edge list, without bringing edges or labels to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from revlens.session import staged


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _oriented(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(moved.union(least.select("a", F.col("m").alias("b"))))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, root): every node of `edges` (a, b) that isn't the smallest of its component.

    Alternating large-star and small-star steps point every node at ever smaller neighbours and
    end in stars; the number of rounds grows with the logarithm of the nodes. Each round is a
    written table, and only minima are gathered per node, combined before the shuffle, so a node
    with very many links is no hot key. No edges, or only loops, give no rows.
    """
    now = staged(_oriented(edges), "components")
    state = _state(now)
    while state[0]:
        now = staged(_small_star(_large_star(now)), "components")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select("a", F.col("b").alias("root"))
