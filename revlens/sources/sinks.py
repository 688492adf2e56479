"""Processed tables, prediction files and metric tables."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def write_processed(df: DataFrame, path: str) -> DataFrame:
    """Write a feature table and go on from it; types and empty texts survive, unlike in CSV."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_predictions(df: DataFrame, path: str, row_id: str = "id", prediction: str = "prediction",
                      name: str = "predicted") -> None:
    """`id` and the prediction as whole numbers, with a header."""
    rows = df.select(F.col(row_id).alias("id"), F.col(prediction).cast("int").alias(name))
    rows.write.mode("errorifexists").option("header", True).csv(path)


def split_name(cutoff: int) -> str:
    return f"binary_split_{cutoff}"


def versions(spark: SparkSession, folder: str, base: str) -> list[int]:
    """Numbers n of the entries `base_v<n>` or `base_v<n>.csv` in a folder of any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names = [s.getPath().getName() for s in system.listStatus(path)]
    found = [re.fullmatch(re.escape(base) + r"_v(\d+)(\.csv)?", n) for n in names]
    return sorted(int(m.group(1)) for m in found if m)


def write_versioned(df: DataFrame, folder: str, base: str, attempts: int = 5, **columns) -> str:
    """Write predictions to the next free version; another writer's version is never replaced."""
    for _ in range(attempts):
        n = max(versions(df.sparkSession, folder, base), default=0) + 1
        target = f"{folder}/{base}_v{n}"
        try:
            write_predictions(df, target, **columns)
            return target
        except AnalysisException as error:
            if "ALREADY_EXISTS" not in str(error.getCondition()):
                raise
    raise RuntimeError(f"no free version of {base} in {folder}")


def write_metrics(df: DataFrame, path: str, by: str = "macro_f1") -> None:
    """Metric rows, best first, in one file."""
    df.orderBy(F.desc(by)).coalesce(1).write.mode("errorifexists").option("header", True).csv(path)
