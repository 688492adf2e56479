"""Session settings and the shared folder in which intermediate tables are cut off."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


SPLIT_BYTES = 128 << 20  # size of a full split of a file scan
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TEXT_BYTES = 8 << 20  # of a text table in a task that counts its n-grams: their table takes about fifty times as much


def session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session for this package; on a cluster the submit settings win over everything here."""
    builder = (
        SparkSession.builder.appName("revlens")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.memory", os.environ.get("REVLENS_DRIVER_MEMORY", "16g"))
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def staging_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (`spark.checkpoint.dir`); a private one only for local runs."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="revlens-"))
    return spark.sparkContext.getCheckpointDir()


def staged(df: DataFrame, name: str = "stage", by: str | None = None, codec: str | None = None, keep_shuffles: bool = True) -> DataFrame:
    """Write `df` once and go on from the written table.

    Training reads its input many times; a table in the shared folder cuts the lineage, keeps
    column pruning and outlives lost executors. With `by`, a column of few values such as a fold, its values are
    partitions of the table: a reader that filters by it opens only their files. `codec` is Parquet's compression.
    Without `keep_shuffles` the write's shuffle files go as it ends, not some time after: nothing else may run in the session meanwhile.
    """
    spark = df.sparkSession
    path, before = f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}", spark.conf.get(SHUFFLE_CLEANUP, None)
    if not keep_shuffles:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(path, compression=codec)
    finally:
        if not keep_shuffles:
            spark.conf.set(SHUFFLE_CLEANUP, before) if before else spark.conf.unset(SHUFFLE_CLEANUP)
    return spark.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns] if by else "*")


def drop_staged(*tables: DataFrame) -> None:
    """Delete tables made by `staged` once nothing reads them any more."""
    for df in tables:
        spark, files = df.sparkSession, df.inputFiles()
        found = re.match(r"(.*-[0-9a-f]{32})/", files[0]) if files else None
        if not found:
            raise ValueError("not a table made by staged()")
        path = spark._jvm.org.apache.hadoop.fs.Path(found[1])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def planned_bytes(df: DataFrame) -> int:
    """The planner's size estimate of a table; nothing is run for it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def pieces(df: DataFrame, piece_bytes: int, least: int, most: int) -> int:
    """Into how many pieces of about `piece_bytes` a table should be cut."""
    return max(least, min(most, -(-planned_bytes(df) // piece_bytes)))


def spread(df: DataFrame, *keys: str, piece_bytes: int = 0) -> DataFrame:
    """Give heavy per-row work every core when a scan is too small to be split that often.

    A scan that fills every core with full-sized splits is returned unchanged, so nothing large
    is ever shuffled for this. With `piece_bytes` a larger input is dealt out too, in pieces of about that size: for work whose
    memory is a large multiple of its input, so that moving the input once costs less than spilling that multiple.
    """
    cores, size = df.sparkSession.sparkContext.defaultParallelism, planned_bytes(df)
    if piece_bytes:
        return df.repartition(max(cores, -(-size // piece_bytes)), *keys)
    if size >= cores * SPLIT_BYTES:
        return df
    return df.repartition(cores, *keys)


def lookup_join(
    df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", max_rows: int = 100_000
) -> DataFrame:
    """Join a per-key table, broadcast only when it was counted and found small.

    Beyond `max_rows` the join is left to the planner and to adaptive execution.
    """
    small = lookup.limit(max_rows + 1).count() <= max_rows
    return df.join(F.broadcast(lookup) if small else lookup, on=on, how=how)


def constant_array(values: list, element: str) -> Column:
    """A literal array; parsed from one string so that long arrays stay one expression."""
    import json

    return F.from_json(F.lit(json.dumps(values)), f"array<{element}>")
